"""Operators against plain versions, on texts with nulls, ties, copies and odd shapes."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronoloom.llm import (
    debruijn,
    decontaminate,
    exchange,
    jaccard_join,
    language,
    licenses,
    pieces,
    preferences,
    quality,
    suffix_dedup,
    toxicity,
)
from chronoloom.llm.components import components
from tests.llm import plain

SCHEMA = "doc_id bigint, text string, lang string, n_chars bigint, id string, row int, pieces string"


def corpus():
    """Copies, near copies, shared passages, a hot line, long words, null and empty texts."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeéñß") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    line, passage, base = text(45), text(60), text(150).split()
    out = [None, "", "   \n\t ", "one", "One", "two words", "x" * 3000, "ab" * 900, "na " * 400, line, line]
    for _ in range(6):
        near = list(base)
        near[rnd.randrange(150)] = "changed"
        out.append(" ".join(near))
    out += [text(rnd.randint(5, 80)) + "\n" + line + "\n" + text(rnd.randint(5, 80)) for _ in range(12)]
    out += [text(30) + " " + passage + " " + text(30) for _ in range(4)]
    out += [" ".join(base)] * 5 + [text(rnd.randint(1, 200)) for _ in range(20)]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "en", len(x or ""), "z", 7, "p") for i, x in rows], SCHEMA)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("hot, page", [(50_000, 1 << 20), (2, 2_000)])
def test_suffix_dedup(docs, rows, hot, page, monkeypatch):
    monkeypatch.setattr(suffix_dedup.Buckets.__init__, "__defaults__", (page,))
    assert found(suffix_dedup.digest(suffix_dedup.dedup_suffixes(docs, hot=hot))) == plain.suffix_dedup(rows)


def test_merge_keeps_order_and_prefixes():
    rnd = random.Random(1)
    runs = [sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 12))) for _ in range(n)) for n in (1, 40, 7, 3, 25)]
    packed = [suffix_dedup.Run(suffix_dedup.encode_run(r, [b""] * len(r), np.arange(len(r)))) for r in runs if any(r)]
    runs = [r for r in runs if any(r)]
    out = [(runs[w][i], k) for w, i, k in suffix_dedup.merge_runs(packed)]
    assert [s for s, _ in out] == sorted(x for r in runs for x in r)
    for (a, _), (b, k) in zip(out, out[1:]):
        assert k == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("page", [1 << 20, 2_000])
def test_passages(docs, rows, page, monkeypatch):
    monkeypatch.setattr(debruijn.Buckets.__init__, "__defaults__", (page,))
    want = [(i, n, r, plain.sha(" ".join(k))) for i, n, r, k in plain.passages(rows)]
    assert found(debruijn.digest(debruijn.dedup_passages(docs))) == want


def test_cut_passages_keeps_columns(docs, rows):
    cut = {r.doc_id: r for r in debruijn.cut_passages(docs).collect()}
    for i, n, removed, kept in plain.passages(rows):
        if removed and removed == n:
            assert i not in cut
        else:
            assert cut[i].text == (" ".join(kept) if removed else rows[i][1])
            assert cut[i].n_chars == len(cut[i].text or "") and cut[i].id == "z" and cut[i].row == 7


@pytest.mark.parametrize("limit, page, crowd", [(jaccard_join.LIMIT, 1 << 20, 256), (1_000, 2_000, 1)])
def test_jaccard(docs, rows, limit, page, crowd, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    monkeypatch.setattr(jaccard_join, "SMALL", crowd)
    monkeypatch.setattr(jaccard_join.Buckets.__init__, "__defaults__", (page,))
    want = sorted((i, *x) for i, x in plain.jaccard(rows).items())
    assert found(jaccard_join.link_documents(docs, limit=limit)) == want


def test_jaccard_schemes_find_all_links():
    """With any allotment of allowances, linked sets share a file."""
    rnd = np.random.default_rng(3)
    for census in ({}, {b: 10**12 for b in range(80)}):
        scheme = jaccard_join.Scheme(80, census)
        for n in (1, 2, 5, 9, 10, 40, 200):
            for _ in range(20):
                a = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
                drop = rnd.integers(0, n // 8 + 1)
                b = np.unique(np.concatenate((a[drop:], rnd.integers(0, 1 << 63, rnd.integers(0, n // 8 + 1)).astype(np.uint64))))
                both = len(np.intersect1d(a, b))
                if 100 * both < 80 * (len(a) + len(b) - both):
                    continue
                sets = jaccard_join.Sets(np.concatenate((a, b)), np.array([len(a), len(b)]))
                owner, keys, marks = sets.files(scheme)
                shared = set(keys[owner == 0]) & set(keys[owner == 1])
                own = {k for k, m in zip(keys, marks) if m & 1}
                assert len({m >> 2 for k, m in zip(keys, marks) if k in shared & own}) >= jaccard_join.AGREE or scheme.distance(int(scheme.band(sets.sizes).min())) == 0
                assert jaccard_join.link(sets, scheme).tolist() == [0, 0]


def test_keep_one(docs, rows):
    groups = plain.jaccard(rows)
    want = sorted(i for i, (n, c) in groups.items() if n == 0 or c == i)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 70), (7, 7)]
    got = found(components(spark.createDataFrame(edges, "u bigint, v bigint")))
    assert got == [(i, 0) for i in range(31)] + [(50, 50), (70, 50), (100, 50)]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 1_000])
def test_decontaminate(spark, docs, rows, block):
    line = rows[9][1]
    items = [(1, line.upper()), (2, " ".join(line.split()[3:20])), (10, "one"), (3, None), (4, ""), (2, "two, WORDS!"), (5, line)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    scanned = decontaminate.scan(docs, bench, block_bytes=block)
    assert found(decontaminate.digest(scanned)) == plain.contamination(rows, items)
    hit = {r.doc_id: r.found for r in scanned.filter("found.n_hit > 0").collect()}
    assert plain.item_words(rows[17][1][hit[17].spans[0].start : hit[17].spans[0].end]) == plain.item_words(line)
    assert [tuple(s) for s in hit[3].spans] == [(0, 3)]


def test_quality(spark):
    rnd = random.Random(2)
    clean = " ".join(f"word{rnd.randrange(10**6)}" for _ in range(40))
    cases = [
        (clean, True), (None, False), ("", False), ("a b c", False), ("the same five words again " * 8, False),
        ("\n".join(["Home | News | Sport | Login | Help | More"] * 2 + [clean[:60]]), False),
        (clean + "\nAll rights reserved.\nHome", True), (clean.upper(), False), (clean.replace(" ", "*** "), False),
    ]
    df = spark.createDataFrame([(i, t, "q") for i, (t, _) in enumerate(cases)], "doc_id int, text string, quality string")
    got = sorted(quality.measure(df).collect())
    assert [r.quality.kept for r in got] == [k for _, k in cases]
    assert got[6].quality.cleaned == clean and got[6].quality.n_bad_lines == 2
    assert got[4].quality.n_repeat_words == 40 and got[1].quality.cleaned is None
    assert [r.text for r in quality.clean(df.drop("quality")).orderBy("doc_id").collect()] == [clean, clean]


def test_pieces_without_dropout_are_the_usual_ones(rows):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [x for _, x in rows if x is not None] + ["  a \t b\n\n", "日本 🙂 text"]
    got = pieces.Encoder(pieces.MODEL, 0, 0.0, 1).encode(texts, [""] * len(texts))
    assert [g.tolist() for g in got] == model.encode(texts)


def test_dropout_varies_and_decodes(spark, rows):
    texts = [x for _, x in rows if x is not None] + ["▁ ▁▁a ▁", "  a \t b\n\n", "日本 🙂 text\x00"]
    coded = [pieces.Encoder(pieces.MODEL, s, 0.3, 4).encode(texts, [str(i) for i in range(len(texts))]) for s in (1, 1, 2)]
    v = pieces.vocabulary(pieces.MODEL)
    assert [pieces.decode_ids(v, g) for g in coded[0]] == texts == [pieces.decode_ids(v, g) for g in coded[2]]
    same = lambda a, b: [x.tolist() == y.tolist() for x, y in zip(a, b)]
    assert all(same(coded[0], coded[1])) and not all(same(coded[0], coded[2]))
    trip = pieces.round_trip(frame(spark, [(0, None), (1, ""), (1, "a b"), (None, "▁x")])).collect()
    assert sorted(r.n_pieces for r in trip)[:2] == [0, 0] and all(r.lossless for r in trip)


def test_toxicity_grammar():
    s = toxicity.Scorer({"zorkl*": 4.0})
    clause = lambda t: s.clause(toxicity.TOKEN.findall(t))
    assert clause("you idiot") > clause("the idiot") > clause("he is not an idiot") > 0
    assert clause("she said the idiot left") < clause("the idiot left")
    assert clause("i will kill you") > 0 == clause("kill time") == clause("thank you")
    assert s.features("zorklaffe.")[2] == 1 and s.features(None) == (0.0, 0.0, 0.0, 0.0)


def test_toxicity_held_out(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = toxicity.score(d, labels).join(labels, "doc_id").filter("held_out").collect()
    right = Counter((r.toxic, r.predicted) for r in got)
    assert right[0, 1] <= 1 and right[1, 1] >= 0.6 * (right[1, 0] + right[1, 1])
    none = toxicity.score(frame(spark, [(1, None), (None, ""), (2, "you idiot")]), labels.limit(0)).collect()
    assert len(none) == 3 and all(0 <= r.score <= 1 for r in none)


def test_language_held_out(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, "12 !?", "en"), (None, "", "fr")], "doc_id bigint, text string, lang string")
    got = language.identify(d.select("doc_id", "text", "lang").union(odd))
    assert got.filter("doc_id < 0 or doc_id is null").filter("lang_pred = 'und' and score = 0").count() == 3
    right = got.join(d, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
    assert language.identify(odd.limit(0)).count() == 0


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT"]
    texts = [None, "", "hello\nReleased under the MIT license\nbye bye", "intro line\n\n" + mit + "\nthe end", mit.replace("Software", "Program", 1), "all of the rights"]
    got = licenses.scan(frame(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [[m.license for m in r.licenses] for r in got] == [[], [], ["MIT notice"], ["MIT"], ["MIT"], []]
    assert (got[3].licenses[0].first_line, got[3].licenses[0].dice) == (2, 1.0)


def test_preferences(spark):
    cols = "pair_id int, turn int, role string, text string, rendered string"
    a = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", "a", "x"), (1, 2, "user", "u", "x"), (1, 2, "user", "v", "x"), (2, 0, "user", None, "x"), (3, 0, "user", "alone", "x"), (None, 0, "user", "n", "x")]
    b = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", "b", "x"), (2, 0, "user", None, "x"), (2, 1, "assistant", "more", "x")]
    got = found(preferences.format_pairs(spark.createDataFrame(a, cols), spark.createDataFrame(b, cols)))
    assert [(p, part, t, trained) for p, part, t, _, trained in got] == [
        (1, "chosen", 1, True), (1, "chosen", 2, False), (1, "chosen", 2, False), (1, "prompt", 0, False), (1, "rejected", 1, True),
        (2, "prompt", 0, False), (2, "rejected", 1, True),
    ]
    assert got[1][3] == "<|user|>\nu<|end|>\n"


def test_empty_tables_and_unusual_ids(spark):
    empty = frame(spark, []).withColumn("found", F.lit(1))
    bench = spark.createDataFrame([], "item_id bigint, text string")
    for df in (
        suffix_dedup.dedup_suffixes(empty), debruijn.dedup_passages(empty), debruijn.cut_passages(empty),
        jaccard_join.link_documents(empty), jaccard_join.keep_one(empty), decontaminate.scan(empty, bench),
        quality.measure(empty), pieces.round_trip(empty), licenses.scan(empty),
    ):
        assert df.count() == 0
    text = " ".join(f"w{i}" for i in range(60))
    odd = frame(spark, [(None, text), (None, text), (5, text), (5, "other")])
    assert sorted(r.n_removed for r in debruijn.dedup_passages(odd).collect()) == [0, 0, 60, 60]
    assert {r.n_removed for r in suffix_dedup.dedup_suffixes(odd).collect()} == {0, len(text)}
    assert sorted(r.component_id for r in jaccard_join.link_documents(odd).collect()) == [5, 5, 5, 5]
    assert jaccard_join.keep_one(odd).count() == 2


def test_keep_one_does_not_go_by_ids(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (None, "c"), (7, text("d")), (7, text("e")), (7, text("e")), (7, "f")]
    kept = jaccard_join.keep_one(frame(spark, rows)).collect()
    assert sorted(r.text for r in kept) == sorted({x for _, x in rows})


@pytest.mark.parametrize("line", ["A 12 34 56 78 90 11 22 33 44 55", "A b C d E f G h I", "1 2 3 4 É", "Ab C 1 2 3", "x 1 2 Y 3 Z"])
def test_quality_capitals_alone(spark, line):
    texts = [f"total values follow here now\n{line}\nend", f"{line}\nend", f"end\n{line}", line, f"# total | & *\n{line}\nend"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = quality.measure(df).orderBy("doc_id").collect()
    assert [r.quality.n_bad_lines for r in got] == [1, 1, 1, 1, 2]
    assert got[0].quality.cleaned == "total values follow here now\nend"


def test_dropout_varies_by_document_and_place():
    word = "unbelievableness"
    texts, names = [f"{word} " * 200] * 3, ["1", "2", "2"]
    encode = lambda t, n: [g.tolist() for g in pieces.Encoder(pieces.MODEL, 7, 0.3).encode(t, n)]
    got = encode(texts, names)
    v = pieces.vocabulary(pieces.MODEL)
    starts = [[i for i, p in enumerate(g) if v.bytes[p][:1] == b" "] + [len(g)] for g in got]
    forms = [{tuple(g[a:b]) for a, b in zip(s, s[1:])} for g, s in zip(got, starts)]
    assert min(map(len, forms)) > 20 and len(forms[0] | forms[1]) > len(forms[0])
    assert got[1] == got[2] == encode(texts[1:2], ["2"])[0] != got[0]


@pytest.mark.parametrize("ids, kind", [([3, 4, 9, 10**12, -5], "bigint"), (["b", "aé", "zz", "", "b1"], "string"), ([8], "int")])
def test_neighbour_pairs_lose_none_to_gaps(spark, ids, kind):
    turns = [(i, t, r, f"{r}{i}") for i in ids for t, r in ((0, "user"), (1, "assistant"))]
    turns += [(None, 0, "assistant", "none"), (type(ids[0])("5"), 0, "user", "no answer")]
    df = spark.createDataFrame(turns, f"conv_id {kind}, turn int, role string, text string")
    got = preferences.format_pairs(*preferences.neighbour_pairs(df)).filter("part = 'rejected'").collect()
    order = sorted(ids)
    want = {i: order[(k + 1) % len(order)] for k, i in enumerate(order) if len(order) > 1}
    assert {r.pair_id: r.rendered for r in got} == {i: f"<|assistant|>\nassistant{j}<|end|>\n" for i, j in want.items()}


def test_neighbour_pairs_of_many_ranges(spark):
    df = spark.range(0, 3000, 3).selectExpr("id as conv_id", "0 as turn", "'assistant' as role", "concat('a', id) as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rejected = preferences.neighbour_pairs(df)[1].collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.pair_id: r.text for r in rejected} == {i: f"a{(i + 3) % 3000}" for i in range(0, 3000, 3)}


def test_licenses_in_running_text():
    scan = licenses.Templates(licenses.TEMPLATES, licenses.THRESHOLD).scan
    names = lambda t: [m[0] for m in scan(t)]
    mit, notice = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["MIT notice"]
    assert scan("This file\nReleased\nunder the MIT License.\nend") == [("MIT notice", 1.0, 1, 2)]
    assert names("This file is released under the MIT License. It has more text.") == ["MIT notice"]
    assert scan("Intro\n" + "\n".join(mit.split()) + "\nend")[0][:3] == ("MIT", 1.0, 1)
    assert names(f"before {notice} between {mit.replace('Software', 'Program', 2)} {notice} after") == ["MIT notice", "MIT", "MIT notice"]
    for name, text in licenses.TEMPLATES.items():
        assert names("some words before it " + " ".join(text.split()) + " and some after") == [name]
    spoilt = licenses.TEMPLATES["Apache-2.0"].replace("compliance", "accord")
    assert names("x " + spoilt + " y") == ["Apache-2.0"]
    assert names("the rights of all, reserved under the software and all that") == []


@pytest.mark.parametrize("limit, page", [(jaccard_join.LIMIT, 1 << 20), (1_000, 2_000)])
def test_jaccard_loses_no_link(spark, rows, limit, page, monkeypatch):
    monkeypatch.setattr(jaccard_join.Buckets.__init__, "__defaults__", (page,))
    chain = [f"c{i}" for i in range(200)]
    more = [" ".join(chain[k : k + 150]) for k in (0, 2, 4, 6, 8)] + [" ".join(chain[4:154]).upper()]
    rows = rows + [(1000 + i, x) for i, x in enumerate(more)]
    sets = {}
    for i, x in rows:
        w = plain.WORD.findall((x or "").translate(plain.LOWER))
        sets[i] = frozenset(tuple(w[a : a + 3]) for a in range(len(w) - 2)) or frozenset({tuple(w)} if w else ())
    alike = lambda a, b: a and b and 100 * len(a & b) >= 90 * len(a | b)
    want = sorted((i, len(s), sum(j != i and bool(alike(s, o)) for j, o in sets.items())) for i, s in sets.items())
    df = frame(spark, rows)
    assert found(jaccard_join.link_counts(df, limit=limit)) == want
    names = {s: min(i for i in sets if sets[i] == s) for s in sets.values()}
    copies = Counter(names[s] for s in sets.values())
    pairs = [(i, copies[i], j, copies[j]) for s, i in names.items() for o, j in names.items() if i < j and alike(s, o)]
    assert found(jaccard_join.set_links(df, limit=limit)) == sorted(pairs) and len(pairs) > 10


@pytest.mark.parametrize("page", [1 << 20, 20_000])
def test_sets_without_company_are_not_filed(spark, page, monkeypatch):
    """Unrelated documents, with copies or without, neither file nor meet by chance."""
    monkeypatch.setattr(jaccard_join.Buckets.__init__, "__defaults__", (page,))
    tables = {}

    def written(df, name, write=jaccard_join.written):
        tables[name] = write(df, name)
        return tables[name]

    monkeypatch.setattr(jaccard_join, "written", written)
    rnd = random.Random(8)
    texts = [" ".join(f"w{rnd.randrange(20_000)}" for _ in range(3000)) for _ in range(40)]
    texts += [*texts[:5], texts[7] + " and more", "short one here now", "short one here now then"]
    rows = list(enumerate(texts))
    got = found(jaccard_join.link_documents(frame(spark, rows), words=5, percent=80))
    assert got == sorted((i, *x) for i, x in plain.jaccard(rows, percent=80, words=5).items())
    assert got[45][2] == 7 and got[44][2] == 4
    filed = tables["filed"]
    assert filed.filter("kind = 0").count() == 2 and tables["chosen"].count() == 2
    assert {r.node for r in filed.collect()} == {r.node for r in tables["chosen"].collect()}


@pytest.mark.parametrize("percent", [50, 75, 80, 95])
def test_jaccard_at_the_limit(spark, percent, monkeypatch):
    """Sets that just link and just do not, copies among them, in many buckets."""
    monkeypatch.setattr(jaccard_join.Buckets.__init__, "__defaults__", (500,))
    rnd, texts = random.Random(percent), []
    for k, n in enumerate((6, 10, 25, 60, 100)):
        base = [f"k{k}n{i}" for i in range(n)]
        texts.append(base)
        for other in range(4):
            # Shared words at the front, others behind, one more or less than the limit allows.
            same = -(-2 * n * percent // (100 + percent)) + other - 2
            texts.append(base[: max(0, same)] + [f"k{k}o{other}n{i}" for i in range(n - max(0, same))])
        texts.append(rnd.choice(texts[-4:]))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = found(jaccard_join.link_documents(frame(spark, rows), words=1, percent=percent))
    assert got == sorted((i, *x) for i, x in plain.jaccard(rows, percent=percent, words=1).items())


def test_cost_of_chance_meetings():
    """Also in bands of few sets, unlike ones seldom meet in `AGREE` segments."""
    for census in (1, 100, 10_000):
        scheme = jaccard_join.Scheme(80, {b: census for b in range(50)})
        for b in range(20, 40):
            m, x = int(scheme.segments[b]), int(scheme.loose[b])
            per = scheme.lows[b] / m
            meet = math.exp(-2 * per) * (m - x + x * (1 + 2 * per))
            chance = 1 - math.exp(-meet) * (1 + meet + meet**2 / 2)
            assert chance * census * scheme.lows[b] < 10 * (m + x * per)


def thue_morse(a, b, n):
    return [(a, b)[i.bit_count() % 2] for i in range(n)]


def test_words_that_polynomials_do_not_tell_apart(spark):
    """No polynomial modulo 2**64 over bytes, or over the hashes of words, tells these apart."""
    x, y = ("".join(thue_morse(*p, 1024)) for p in ("ab", "ba"))
    words = [f"w{i}" for i in range(19)]
    long = [thue_morse(*p, 1024) for p in (("left", "right"), ("right", "left"))]
    rows = [(0, " ".join([*words, x])), (1, " ".join([*words, y])), (2, x), (3, y)]
    rows += [(4 + i, " ".join(["start", *w, "end"])) for i, w in enumerate(long)]
    df = frame(spark, rows)
    want = [(i, n, r, plain.sha(" ".join(k))) for i, n, r, k in plain.passages(rows)]
    assert found(debruijn.digest(debruijn.dedup_passages(df))) == want and want[1][2] == 0
    assert found(jaccard_join.link_documents(df)) == sorted((i, *g) for i, g in plain.jaccard(rows).items())


def test_no_letters_no_language(spark):
    rows = [(i, t, "es") for i, t in enumerate(["hola que tal", "² ½ ①", "12_3 !?", "١٢", "ª", "ñ"] * 4)]
    got = language.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert {rows[r.doc_id][1]: r.lang_pred for r in got} == {
        "hola que tal": "es", "² ½ ①": "und", "12_3 !?": "und", "١٢": "und", "ª": "es", "ñ": "es"
    }


def test_language_scores_are_plain_bayes():
    texts = {"a": ["aab ab", "ba é"], "b": ["ccd", "cd dc é"]}
    counts = np.zeros((2, 64))
    for i, ts in enumerate(texts.values()):
        for columns in language.hashed_runs(ts, 2, 64)[0]:
            counts[i] += np.bincount(columns, minlength=65)[:64]
    model = language.Model(["a", "b"], np.array([3.0, 1.0]), counts, 2)
    for t in ("ab", "dc", "é", "abcd ab"):
        logs = np.log([0.75, 0.25])
        for i in range(2):
            p = (counts[i] + 0.5) / (counts[i] + 0.5).sum()
            logs[i] += sum(np.log(p[c]) for columns in language.hashed_runs([t], 2, 64)[0] for c in columns if c < 64)
        share = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
        ((lang, score),) = model.score([t])
        assert lang == "ab"[int(share.argmax())] and abs(score - share.max()) < 1e-4


def test_samples_of_any_size(spark):
    from chronoloom.llm.text import sampled

    ids = spark.range(200_000)
    for n in (200_000, 10**12, 10**15, 10**18):
        most = 50_000 if n == 200_000 else n // 4
        assert abs(ids.filter(sampled(n, most, "id")).count() - 50_000) < 2_000
    assert ids.filter(sampled(10**15, 20_000, "id")).count() <= 1


def test_short_keys_tell_whole_ones_apart():
    """Even keys with equal lower halves count as one key, odd ones never do."""
    keys = np.sort(np.array([(a << 32) | b for a in range(4) for b in (2, 3, 4 + 2 * a, 5 + 2 * a)], np.uint64))
    assert exchange._unpack(exchange._pack(keys, False), len(keys), False).tolist() == keys.tolist()
    table = pa.table(
        {
            "target": pa.array([0, 0], pa.int32()),
            exchange.BUCKET: pa.array([1, 0], pa.int32()),
            "keys": [exchange._pack(keys[8:], True), exchange._pack(keys[:8], True)],
            "counts": [np.ones(8, "u1").tobytes()] * 2,
        }
    )
    answers = exchange._answer(1 << 62, "u1", True)(table)
    for bucket, mine in ((0, keys[:8]), (1, keys[8:])):
        flags = exchange.read_answers(mine, answers.filter(pa.array([b == bucket for b in (0, 1)])), 1)
        twos, odd = (mine & np.uint64(0xFFFFFFFF)) == 2, (mine & np.uint64(1)) == 1
        assert flags[0].tolist() == twos.tolist()  # said to be repeated: only the even ones that look alike
        assert flags[1][odd].all() and flags[1][twos].sum() == (bucket == 0)
