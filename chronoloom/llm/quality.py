"""Line-first quality cleaning, in DataFrame functions only.

Each line is judged by itself: punctuation (symbols, repeated exclamation marks, capitals only),
navigation (separators, menu words) and boilerplate (licence and cookie phrases). Lines that fail
are taken out. A document is rejected if too little of its text is left, or if it fails the base
rules on its words. Nothing is exploded or shuffled: a document is one row from start to end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns in the common subset of Java and RE2.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
NO_SYMBOL = r"[^#*$%&|<>]+"
SHOUT = r"!!|\?\?"
NO_SEPARATOR = r"[^|»·•]+"
NO_UPPER = r"\P{Lu}+"
NO_LETTER = r"\P{L}+"
MENU = (
    r"(?i)^[\x20\x09-\x0D]*(home|menu|log ?in|sign ?(in|up)|register|next|previous|search|share|print|"
    r"back to top|skip to content|about us|contact us|read more|sitemap)[\x20\x09-\x0D.:]*$"
)
BOILERPLATE = (
    r"(?i)all rights reserved|\blicen[sc]ed under\b|\breleased under the\b|\bcopyright\b|©|"
    r"\bterms of (use|service)\b|\bprivacy policy\b|\b(accept|use|uses) cookies\b|\bsubscribe to our\b|"
    r"\benable javascript\b|\blorem ipsum\b"
)
#: Every failing line has one of these; texts without any need no look at their lines. A line with more
#: capitals than other letters has two with at most one letter between, or one that is its only letter.
SUSPECT = (
    r"[#*$%&|<>»·•©]|!!|\?\?|\p{Lu}\P{L}*+(?:\p{L}\P{L}*+)?\p{Lu}|"
    r"(?:\A|\n)[^\p{L}\n]*+\p{Lu}[^\p{L}\n]*+(?:\n|\z)"
)
SUSPECT_WORDS = (
    "all rights reserved", "licensed under", "licenced under", "released under the", "copyright", "terms of",
    "privacy policy", "cookies", "subscribe to our", "enable javascript", "lorem ipsum",
)
SUSPECT_MENU = MENU.replace("(?i)^", "(?im)^")
SYMBOL = r"[#*$%&|<>]"
TRIM = " \t\n\x0b\x0c\r"
BOILERPLATE_WORDS = 30
RUN = 5


def _words(c: Column) -> Column:
    """Words between ASCII white space; none for a text without any."""
    text = F.btrim(c, F.lit(TRIM))
    return F.when(F.length(text) > 0, F.split(text, SPACE)).otherwise(F.array().cast("array<string>"))


def _rest(c: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(c, pattern, ""))


def _line(line: Column) -> Column:
    """The line, its number of words and whether it fails."""
    return F.struct(line.alias("line"), F.size(_words(line)).alias("n"))


def _fails(x: Column) -> Column:
    line, n = x["line"], x["n"]
    symbols = _rest(line, NO_SYMBOL)
    shouts = F.size(F.split(line, SHOUT)) - 1
    capitals = (n >= 5) & (2 * _rest(line, NO_UPPER) > _rest(line, NO_LETTER))
    punctuation = ((symbols >= 3) & (5 * symbols >= n)) | ((shouts >= 2) & (3 * shouts >= n)) | capitals
    separators = _rest(line, NO_SEPARATOR)
    navigation = ((separators >= 2) & (6 * separators >= n)) | line.rlike(MENU)
    boilerplate = (n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE)
    return (n > 0) & (punctuation | navigation | boilerplate)


def _repeated(words: str, grams: str, seats: str, docs: DataFrame) -> DataFrame:
    """Adds the number of words in runs of RUN words that the text has more than once."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    docs = docs.withColumn(grams, hashed)
    last = F.size(grams) - RUN
    run = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(F.col(grams), i + k) for k in range(RUN)])
    )
    docs = docs.withColumn(grams, F.when(last >= 0, run))
    again = F.size(F.array_distinct(grams)) < F.size(grams)
    seated = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    docs = docs.withColumn(seats, F.when(again, seated))

    def twin(x: Column, j: Column) -> Column:
        near = [F.get(F.col(seats), j + k)["g"] == x["g"] for k in (-1, 1)]
        return F.when(F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False)), x["i"])

    twins = F.sort_array(F.array_compact(F.transform(seats, twin)))
    docs = docs.withColumn(seats, F.when(F.col(seats).isNotNull(), twins))
    # Every repeated run brings its own words up to the start of the next one.
    step = F.transform(
        seats, lambda p, j: F.least(F.lit(RUN), F.coalesce(F.get(F.col(seats), j + 1) - p, F.lit(RUN)))
    )
    total = F.aggregate(step, F.lit(0), lambda a, x: a + x)
    return docs.withColumn(seats, F.coalesce(total, F.lit(0)).cast("bigint"))


def measure(docs: DataFrame, text_col: str = "text", min_left: int = 50) -> DataFrame:
    """The documents with a struct `quality`.

    Fields: n_words, word_chars, n_symbols, n_dup_lines (lines with a word, equal to an earlier
    one), n_repeat_words (in 5-word runs found twice or more), n_lines, n_bad_lines, n_left_words,
    cleaned (the text without failing lines), base_failed (under 10 words, or more than a fifth
    of them repeated) and kept: not base_failed, and at least `min_left` percent of the words
    left. Runs are compared by 64-bit hashes within the text. A null or empty text has no words
    and fails; `cleaned` is null for null. A column called `quality` is replaced; others stay.
    """
    cols = [c for c in docs.columns if c != "quality"]
    x = docs.select(F.struct(*cols).alias("row"), F.col(text_col).alias("text"))
    text = F.coalesce("text", F.lit(""))
    lower = F.lower(text)
    suspect = text.rlike(SUSPECT) | text.rlike(SUSPECT_MENU)
    for words in SUSPECT_WORDS:
        suspect = suspect | lower.contains(words)
    x = x.withColumn("words", _words(text)).withColumn("split", F.split(text, "\n"))
    x = x.withColumn("lines", F.when(suspect, F.transform("split", _line)))
    checked = F.transform("lines", lambda y: F.struct(y["line"].alias("line"), y["n"].alias("n"), _fails(y).alias("bad")))
    x = x.withColumn("checked", checked)
    x = _repeated("words", "grams", "repeats", x)
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, y: a + y["n"])
    x = x.withColumn("good", F.filter("checked", lambda y: ~y["bad"]))
    x = x.withColumn("worded", F.filter("split", lambda y: y.rlike(WORD)))
    n = F.size("words")
    left = F.coalesce(total("good"), n)
    bad = F.when(F.col("checked").isNotNull(), F.size("checked") - F.size("good")).otherwise(0)
    cleaned = F.coalesce(F.array_join(F.transform("good", lambda y: y["line"]), "\n"), F.col("text"))
    x = x.select(
        "row",
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.when(text.rlike(SYMBOL), _rest(text, NO_SYMBOL)).otherwise(0).cast("bigint").alias("n_symbols"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("bigint").alias("n_dup_lines"),
        F.col("repeats").alias("n_repeat_words"),
        F.size("worded").cast("bigint").alias("n_lines"),
        bad.cast("bigint").alias("n_bad_lines"),
        left.cast("bigint").alias("n_left_words"),
        F.when(F.col("text").isNotNull(), cleaned).alias("cleaned"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    kept = ~F.col("base_failed") & (100 * F.col("n_left_words") >= min_left * F.col("n_words"))
    x = x.withColumn("base_failed", failed).withColumn("kept", kept)
    measured = F.struct("row", F.struct(*[c for c in x.columns if c != "row"]).alias("quality"))
    # A filter on the result must not be pushed down into the expressions, which it would repeat.
    return x.select(F.explode(F.array(measured)).alias("m")).select("m.row.*", "m.quality")


def clean(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", **options) -> DataFrame:
    """The kept documents with their failing lines taken out, and the columns they came with."""
    x = measure(docs, text_col, **options).filter("quality.kept")
    x = x.withColumn(text_col, F.col("quality.cleaned")).drop("quality")
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        x = x.withColumn(chars_col, F.length(text_col).cast(kind))
    return x.select(*docs.columns)


def digest(measured: DataFrame, id_col: str = "doc_id") -> DataFrame:
    names = (
        "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_bad_lines n_left_words base_failed kept"
    )
    return measured.select(F.col(id_col).alias("doc_id"), *[F.col(f"quality.{c}") for c in names.split()])
