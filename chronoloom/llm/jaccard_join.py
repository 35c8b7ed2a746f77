"""Exact join of word n-gram sets by Jaccard similarity, on partitions of the token universe.

Sets whose sizes fall into one band, or into neighbouring ones, share a scheme: hashed tokens
are dealt into m segments. Linked sets differ in at most H tokens, so if the segments' allowances
a_i (0: the subset must be equal, 1: one token may be missing) satisfy sum(a_i + 1) > H + 4, three
segments of the two at least agree within their allowances. Each set is filed under its subset in every
segment, and where one token may be missing also under each one-deletion neighbour. A cost model
allots the allowances by band: more allowances mean fewer but larger segments, so more filings
of a set but fewer sets that meet by chance, which pays off as bands fill up.

Linked sets share most tokens, so a set with too many tokens that no other set has links with
nothing. A part of the tokens tells which ones have company (`exchange`); sets without are not
filed, so unrelated documents, however many, neither crowd files nor meet by chance.

Files with one set are dropped unseen (`exchange`), equal sets are one from the start, and sets
that share files are verified with their whole token sets inside their candidate component. A
pair that is linked already through others is not compared again, so a group of near copies
costs no list of its pairs, unless the links themselves are asked for (`set_links`, `link_counts`). A component over `limit` bytes is dealt out as pairs of blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.components import components
from chronoloom.llm.exchange import BUCKET, PAGE, Buckets, ask_repeated, bucket_map, read_answers, text_bytes, written
from chronoloom.llm.text import Texts, U, give_back, mix, ngrams, runs_hash

LIMIT = 8 << 20
#: Segments in which linked sets agree at least.
AGREE = 3
#: Sets that a file may have for its pairs to be written out: own ones if its subset has one token or none, else all.
CROWD, SMALL = 256, 8
#: Holders of a token that are counted.
MET = 2
DOC, FILE = 0, 1
_C = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


class Scheme:
    """Bands, segments and allowances for links of at least `percent`."""

    def __init__(self, percent: int, census: dict[int, int] | None = None):
        if not 50 <= percent <= 100:
            raise ValueError("percent must be from 50 to 100")
        self.percent = percent
        self.lows = [1]
        while self.lows[-1] < 1 << 40:
            self.lows.append(100 * self.lows[-1] // percent + 1)
        self.low = np.array(self.lows)
        plans = [self._plan(i, census or {}) for i in range(len(self.lows) - 2)]
        self.segments = np.array([m for m, _ in plans])
        self.loose = np.array([x for _, x in plans])

    def band(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, n, "right") - 1

    def distance(self, band: int) -> int:
        """Most tokens in which a set of this band and one of this or the next can differ."""
        small = self.lows[band + 1] - 1
        return (100 - self.percent) * (small + 100 * small // self.percent) // (100 + self.percent)

    def _plan(self, band: int, census: dict[int, int]) -> tuple[int, int]:
        """(segments, how many of them allow a missing token) at the least cost."""
        h, n = self.distance(band), self.lows[band]
        sets = census.get(band, 0) + census.get(band + 1, 0)
        best = None
        for x in sorted({round((h + 2 * AGREE - 1) // 2 * f / 16) for f in range(17)}):
            # A segment counts for 2 at most, so AGREE of them agree; without distance sets are equal.
            m = h + 2 * AGREE - 1 - x if h else 1
            x = min(x, m) if h else 0
            per = n / m
            alike = math.exp(-min(700, 2 * per))  # that two unlike sets leave a segment empty
            meet = alike * ((m - x) + x * (1 + 2 * per))
            # Two unlike sets that meet in AGREE segments are compared token by token.
            few = math.exp(-meet) * sum(meet**k / math.factorial(k) for k in range(AGREE))
            cost = m + x * per + sets * (meet + max(0, 1 - few) * n)
            best = min(best or (cost, m, x), (cost, m, x))
        return best[1], best[2]


class Sets:
    """Token sets one after the other, each sorted."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray):
        self.tokens, self.sizes = tokens, sizes
        self.offs = np.concatenate(([0], np.cumsum(sizes)))

    @staticmethod
    def of_texts(t: Texts, words: int) -> Sets:
        h = t.word_hashes()
        at, tokens = ngrams(h, t.first, words)
        doc = t.word_doc()[at]
        short = np.flatnonzero((np.diff(t.first) > 0) & (np.diff(t.first) < words))
        tokens = np.concatenate((tokens, runs_hash(h, t.first[short], t.first[short + 1])))
        doc = np.concatenate((doc, short))
        by = np.argsort(tokens)
        # A stable sort of short numbers takes time in proportion.
        by = by[np.argsort(doc[by].astype(np.min_scalar_type(t.n)), kind="stable")]
        tokens, doc = tokens[by], doc[by]
        fresh = np.ones(len(tokens), bool)
        fresh[1:] = (tokens[1:] != tokens[:-1]) | (doc[1:] != doc[:-1])
        return Sets(tokens[fresh], np.bincount(doc[fresh], minlength=t.n))

    def names(self) -> np.ndarray:
        """One hash for each whole set."""
        s = np.concatenate((np.zeros(1, U), np.cumsum(mix(self.tokens ^ _C[0]), dtype=U)))
        return mix((s[self.offs[1:]] - s[self.offs[:-1]]) * _C[1] + self.sizes.astype(U))

    def pick(self, which: np.ndarray) -> Sets:
        sizes = self.sizes[which]
        at = np.repeat(self.offs[which] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        return Sets(self.tokens[at + np.arange(len(at))], sizes)

    def files(self, scheme: Scheme) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(set, key, mark) for every file a set belongs to; empty sets have none.

        A mark holds the band and segment, whether the file's subset has one token at most, and
        whether it is the set's own one, not a neighbour.
        """
        band = scheme.band(self.sizes)
        owners, keys, marks = [], [], []
        for lower in (0, 1):
            use = np.flatnonzero((self.sizes > 0) & (band >= lower))
            if not len(use):
                continue
            s, b = self.pick(use), band[use] - lower
            m, x = scheme.segments[b], scheme.loose[b]
            base = np.cumsum(m) - m
            doc = np.repeat(np.arange(len(use)), s.sizes)
            part = (((s.tokens >> U(32)) * m[doc].astype(U)) >> U(32)).astype(np.int64)
            value = mix(s.tokens)
            count = np.bincount(base[doc] + part, minlength=int(m.sum()))
            sums = np.concatenate((np.zeros(1, U), np.cumsum(value, dtype=U)))
            end = np.cumsum(count)
            subset = sums[end] - sums[end - count]
            seg_doc = np.repeat(np.arange(len(use)), m)
            seg = np.arange(len(seg_doc)) - base[seg_doc]
            salt = b[seg_doc].astype(U) * _C[1] + seg.astype(U) * _C[2]
            owners.append(use[seg_doc])
            keys.append(mix(mix(subset) + salt))
            place = (b[seg_doc] << 24) + seg
            marks.append((place << 2) | ((count < 2) << 1) | 1)
            loose = np.flatnonzero(part < x[doc])
            if len(loose):
                at = base[doc[loose]] + part[loose]
                owners.append(use[doc[loose]])
                keys.append(mix(mix(subset[at] - value[loose]) + salt[at]))
                marks.append((place[at] << 2) | ((count[at] < 3) << 1))
        if not owners:
            return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
        return np.concatenate(owners), np.concatenate(keys), np.concatenate(marks)


def _read(table: pa.Table, words: int) -> tuple[Sets, np.ndarray, np.ndarray]:
    """Sets of a bucket's documents, their names, and the first row of each different one."""
    sets = Sets.of_texts(Texts(text_bytes(table)).lower().find_words(), words)
    names = sets.names()
    _, first = np.unique(names, return_index=True)
    return sets, names, np.sort(first[sets.sizes[first] > 0])


def _asked(files: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Keys of files, even, as a lonely file that is asked for in vain does no harm, and of names, odd."""
    return np.concatenate((files & ~U(1), mix(names) | U(1)))


def token_part(percent: int) -> int:
    """Of so many tokens one is asked for, so that two fifths of a set's tokens, held by no other, rule it out."""
    return 1 << max(0, (40 // max(1, 100 - percent)).bit_length() - 1)


def _some_tokens(sets: Sets, percent: int) -> np.ndarray:
    return np.flatnonzero((sets.tokens & U(token_part(percent) - 1)) == 0)


def _token_keys(words: int, percent: int):
    def fn(table: pa.Table) -> np.ndarray:
        sets, names, first = _read(table, words)
        sets = sets.pick(first)
        return _asked(sets.tokens[_some_tokens(sets, percent)], names[first])

    return fn


def _with_company(words: int, percent: int, answering: int):
    """A row for each document; those of the first one of each set that may have links hold its text.

    Of a set's tokens, a linked one lacks (100 - percent) in 100 at most. A token is held by no
    other set if as many sets of buckets have it as have the whole set, which is told up to two.
    """

    def fn(table: pa.Table, answers: pa.Table) -> pa.Table:
        all_sets, names, first = _read(table, words)
        sets = all_sets.pick(first)
        some = _some_tokens(sets, percent)
        flags = read_answers(_asked(sets.tokens[some], names[first]), answers, answering)
        held = 1 + flags[0].astype(np.int8) + flags[2]
        owner = np.repeat(np.arange(len(first)), sets.sizes)[some]
        own = (held[: len(some)] == held[len(some) :][owner]) & (held[: len(some)] <= MET)
        lacking = np.bincount(owner[own], minlength=len(first))
        may = flags[1][len(some) :] & (100 * lacking <= (100 - percent) * sets.sizes)
        chosen = np.zeros(len(names), bool)
        chosen[first[may]] = True
        text = table.column("text")
        return pa.table(
            {
                "id": table.column("id"),
                BUCKET: table.column(BUCKET),
                "row": pa.array(np.arange(len(names)), pa.int32()),
                "size": pa.array(all_sets.sizes, pa.int64()),
                "node": pa.array(names.view(np.int64)),
                "text": pc.if_else(pa.array(chosen), text, pa.scalar(None, text.type)),
            }
        )

    return fn


def _keys(words: int, scheme: Scheme):
    def fn(table: pa.Table) -> np.ndarray:
        sets, names, first = _read(table, words)
        return _asked(sets.pick(first).files(scheme)[1], names[first])

    return fn


def _filed(words: int, scheme: Scheme, answering: int):
    """A row for each document, and one for each shared file of each set's first document."""

    def fn(table: pa.Table, answers: pa.Table) -> pa.Table:
        sets, names, first = _read(table, words)
        owner, keys, marks = sets.pick(first).files(scheme)
        flags = read_answers(_asked(keys, names[first]), answers, answering)
        shared, mine = flags[0][: len(keys)], flags[1][len(keys) :]
        use = shared & mine[owner]
        nodes, keys, marks = names[first[owner[use]]], keys[use], marks[use]
        only = _unique_pairs(nodes, keys)
        nodes, keys, marks = nodes[only], keys[only], marks[only]
        is_first = np.zeros(len(names), bool)
        is_first[first[mine]] = True
        n, f, bucket = len(names), len(nodes), table.column(BUCKET)[0].as_py()
        as_long = lambda x: x.astype(U).view(np.int64)
        no_id = pa.nulls(f, table.column("id").type)
        return pa.table(
            {
                "kind": pa.array(np.repeat([DOC, FILE], [n, f]), pa.int32()),
                "id": pa.chunked_array([*table.column("id").chunks, no_id]),
                BUCKET: pa.array(np.full(n + f, bucket), pa.int32()),
                "row": pa.array(np.concatenate((np.arange(n), np.full(f, -1))), pa.int32()),
                "size": pa.array(np.concatenate((sets.sizes, marks)), pa.int64()),
                "node": pa.array(np.concatenate((as_long(names), as_long(nodes)))),
                "file": pa.array(np.concatenate((is_first.astype(np.int64), as_long(keys)))),
            }
        )

    return fn


def _texts_of(table: pa.Table, chosen: pa.Table) -> pa.Table:
    """Texts of the chosen rows; they are smaller than their tokens, which hashes make incompressible."""
    texts = table.take(chosen.column("row").combine_chunks()).column("text").cast(pa.binary())
    return pa.table({**{c: chosen.column(c) for c in ("component", "node", "blocks")}, "text": texts})


def _sets_of(texts: list[bytes], words: int) -> Sets:
    """Token sets of the texts, made from about `PAGE` bytes at a time."""
    page = np.cumsum([len(t) for t in texts]) // PAGE
    cut = [0, *(np.flatnonzero(np.diff(page)) + 1).tolist(), len(texts)]
    parts = [Sets.of_texts(Texts(texts[a:b]).lower().find_words(), words) for a, b in zip(cut, cut[1:])]
    return Sets(np.concatenate([p.tokens for p in parts]), np.concatenate([p.sizes for p in parts]))


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where the first of each different pair (a, b) is, in their order."""
    by = np.lexsort((b, a))
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])
    return by[fresh]


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Root of each of `at`, which then points to it."""
    root = parent[at]
    while True:
        up = parent[root]
        if (up == root).all():
            parent[at] = root
            return root
        root = up


def link(sets: Sets, scheme: Scheme, side: np.ndarray | None = None, links: list | None = None) -> np.ndarray:
    """For each set the least index it is linked with, directly or through others.

    With `side`, only sets of different sides are compared. With `links`, sets that are connected
    already are compared too, and each linked pair is put there once, as two arrays of indexes.
    """
    n = len(sets.sizes)
    root = np.arange(n)
    by = np.argsort(sets.sizes, kind="stable")
    place = np.empty(n, np.int64)
    place[by] = np.arange(n)
    sized = sets.sizes[by]
    p = scheme.percent
    owner, keys, _ = sets.files(scheme)
    only = _unique_pairs(keys, owner)
    owner, keys = owner[only], keys[only]
    _, file, members = np.unique(keys, return_inverse=True, return_counts=True)
    file_end = np.cumsum(members)
    own = np.argsort(owner, kind="stable")
    own_end = np.searchsorted(owner[own], np.arange(n), "right")
    own_start = np.searchsorted(owner[own], np.arange(n), "left")
    _, token = np.unique(sets.tokens, return_inverse=True)
    flag = np.zeros(len(token) + 1, bool)
    for rank, i in enumerate(by.tolist()):
        # Later ones by size that are small enough: 100 * n_i >= p * n_j.
        reach = np.searchsorted(sized, 100 * sets.sizes[i] // p, "right")
        if reach <= rank + 1:
            continue
        mine = file[own[own_start[i] : own_end[i]]]
        if members[mine].sum() < 4 * (reach - rank):
            lists = [owner[file_end[f] - members[f] : file_end[f]] for f in mine.tolist() if members[f] > 1]
            near = np.unique(np.concatenate(lists)) if lists else np.zeros(0, np.int64)
            near = near[(place[near] > rank) & (place[near] < reach)]
        else:
            near = by[rank + 1 : reach]
        if links is None:
            near = near[_roots(root, near) != _roots(root, np.array([i]))[0]]
        if side is not None:
            near = near[side[near] != side[i]]
        if not len(near):
            continue
        a, size = sets.offs[i], sets.sizes[i]
        flag[token[a : a + size]] = True
        for part in np.array_split(near, 1 + int(sets.sizes[near].sum()) // 4_000_000):
            cut = sets.sizes[part]
            starts = np.cumsum(cut) - cut
            at = np.repeat(sets.offs[part] - starts, cut) + np.arange(int(cut.sum()))
            both = np.add.reduceat(flag[token[at]].astype(np.int64), starts)
            hit = part[100 * both >= p * (size + cut - both)]
            if len(hit):
                if links is not None:
                    links.append((np.full(len(hit), i), hit))
                roots = _roots(root, np.append(hit, i))
                root[roots] = roots.min()
        flag[token[a : a + size]] = False
    return _roots(root, np.arange(n))


def _verify(scheme: Scheme, words: int, every: bool):
    """(node, other node it belongs with) for the sets of some candidate components.

    With `every`, all linked pairs; else enough of them to connect what is linked.
    """

    def fn(table: pa.Table) -> pa.Table:
        comp = table.column("component").to_numpy()
        node = table.column("node").to_numpy()
        all_sets = _sets_of(table.column("text").to_pylist(), words)
        block = table.column("block").to_numpy()
        blocks = table.column("blocks").to_numpy()
        pair = table.column("pair").to_numpy()
        out_a, out_b = [], []
        by = np.lexsort((node, pair, comp))
        cut = np.flatnonzero(np.concatenate(([True], np.diff(comp[by]) != 0)) | np.concatenate(([True], np.diff(pair[by]) != 0)))
        for group in np.split(by, cut[1:]):
            sets = all_sets.pick(group)
            # Sets of one block meet where it is paired with itself, and nowhere else.
            low, high = divmod(int(pair[group[0]]), int(blocks[group[0]]))
            links: list | None = [] if every else None
            root = link(sets, scheme, block[group] if low != high else None, links)
            if links is None:
                moved = np.flatnonzero(root != np.arange(len(group)))
                links = [(moved, root[moved])]
            for a, b in links:
                out_a.append(node[group[a]])
                out_b.append(node[group[b]])
            del sets
            give_back()
        none = [np.zeros(0, np.int64)]
        return pa.table({"u": pa.array(np.concatenate(out_a or none)), "v": pa.array(np.concatenate(out_b or none))})

    return fn


def _candidates(files: DataFrame) -> DataFrame:
    """Edges (u, v) that connect all sets which may be linked.

    Subsets of few tokens agree by chance, and in a large corpus that connects every set with
    every other. But linked sets agree in `AGREE` segments, so pairs of sets in small files count only
    if they share files of so many segments. Pairs of two neighbours of a file's subset differ too
    much and do not count. The sets of larger files are connected through the least of them; a pair
    that shares one of these needs no other.
    """
    own, tiny = F.col("size").bitwiseAND(1) == 1, F.col("size").bitwiseAND(2) == 2
    # Dealt by file once, for the hubs and for the rows that join them.
    files = files.select("file", "node", "size").repartition("file")
    hubs = files.groupBy("file").agg(
        F.min("node").alias("v"), F.max("node").alias("m"), F.count(F.lit(1)).alias("n"),
        F.count_if(own).alias("owns"), F.max(tiny).alias("few"),
    )
    shared = files.join(hubs.filter("v < m and owns > 0"), "file").withColumns(
        {"seg": F.shiftright("size", 2), "own": own}
    )
    by_pairs = (F.col("few") & (F.col("owns") <= CROWD)) | (F.col("n") <= SMALL)
    star = shared.filter(~by_pairs).select(F.col("node").alias("u"), "v")
    small = shared.filter(by_pairs)
    own_ones = small.filter("own").select("file", F.col("node").alias("mine"))
    pairs = small.join(own_ones, "file").filter("node <> mine")
    pairs = pairs.groupBy(F.greatest("node", "mine").alias("u"), F.least("node", "mine").alias("v"))
    agreed = pairs.agg(F.size(F.collect_set("seg")).alias("segments")).filter(F.col("segments") >= AGREE)
    return star.union(agreed.select("u", "v"))


def _verified(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    percent: int = 90,
    limit: int = LIMIT,
    every: bool = False,
) -> tuple[Buckets, DataFrame, DataFrame, int]:
    """Buckets, their rows, what `_verify` finds among their sets, and the most blocks of a component."""
    probe = Scheme(percent)
    buckets = Buckets(docs, id_col, text_col)
    id_type, text_type = (docs.schema[c].dataType.simpleString() for c in (id_col, text_col))
    answers, answering = ask_repeated(buckets, _token_keys(words, percent), 15 * token_part(percent), MET, short=True)
    rows = written(
        bucket_map(
            buckets, answers, _with_company(words, percent, answering),
            f"id {id_type}, {BUCKET} int, row int, size bigint, node bigint, text {text_type}",
        ),
        "sets",
    )
    docs_rows = rows.drop("text")
    able = rows.filter("text is not null").select("node", "text", "size")
    base = math.log(100 / min(percent, 99))
    census: dict[int, int] = {}
    for r in able.groupBy(F.floor(F.log("size") / F.lit(base)).alias("b")).count().collect():
        # a row for each power of 100 / percent
        b = int(probe.band(np.array([max(1, int(math.exp(base * r.b)))]))[0])
        census[b] = census.get(b, 0) + r["count"]
    scheme = Scheme(percent, census)
    able = Buckets(able.select("node", "text"), "node", "text")
    answers, answering = ask_repeated(able, _keys(words, scheme), 24, short=True)
    filed = written(
        bucket_map(
            able, answers, _filed(words, scheme, answering),
            f"kind int, id bigint, {BUCKET} int, row int, size bigint, node bigint, file bigint",
        ),
        "filed",
    )
    candidates = components(_candidates(filed.filter(F.col("kind") == FILE)))
    first = filed.filter((F.col("kind") == DOC) & F.expr("file = 1 and size > 0")).select("node", BUCKET, "row", "size")
    chosen = candidates.join(first, "node")
    blocks = chosen.groupBy("component").agg(F.ceil(F.sum("size") * 8 / F.lit(limit)).cast("int").alias("blocks"))
    chosen = written(chosen.join(blocks, "component"), "chosen")
    total = chosen.agg(F.sum("size").alias("s"), F.max("blocks").alias("b")).first()
    sets = bucket_map(
        able, chosen.select(BUCKET, "row", "component", "node", "blocks"), _texts_of,
        "component bigint, node bigint, blocks int, text binary",
    )
    bundles = max(1, math.ceil((total.s or 0) * 8 / (4 << 20)))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = sets.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    low, high = F.least("block", "other"), F.greatest("block", "other")
    dealt = dealt.withColumn("pair", low * F.col("blocks") + high).withColumn(
        "bundle",
        F.when(F.col("blocks") > 1, F.xxhash64("component", "pair")).otherwise(
            F.pmod(F.xxhash64("component"), F.lit(bundles))
        ),
    )
    found = dealt.groupBy("bundle").applyInArrow(_verify(scheme, words, every), "u bigint, v bigint")
    return buckets, docs_rows, found, total.b or 0


def join_sets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> tuple[Buckets, DataFrame]:
    """Buckets, and for each of their rows (bucket, row, id, size, component, component_id).

    `component` is a number of its own for each component, whatever the ids are.
    """
    buckets, docs_rows, found, blocks = _verified(docs, id_col, text_col, **options)
    if blocks > 1:
        links = components(found)
    else:  # each set was seen in one place only, so these are components already
        links = found.select(F.col("u").alias("node"), F.col("v").alias("component"))
    group = F.coalesce(F.col("component"), F.col("node"))
    named = written(docs_rows.join(links, "node", "left").withColumn("component", group), "named")
    least = named.filter("size > 0").groupBy("component").agg(F.min("id").alias("least"))
    result = named.filter("size > 0").join(least, "component").withColumn("component_id", F.col("least"))
    empty = named.filter("size = 0").withColumn("component_id", F.col("id"))
    cols = [BUCKET, "row", "id", "size", "component", "component_id"]
    return buckets, result.select(*cols).union(empty.select(*cols))


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document the size of its n-gram set and the least id that links connect it with.

    Two documents link if 100 * intersection >= percent * union of their sets of `words`-word
    runs, A-Z in lower case; a text with fewer words is one run. Texts without words, null ones
    included, have an empty set and link with nothing, themselves apart. Sets are compared as
    sets of 64-bit hashes. Each row is a document of its own; a null id is passed over for
    component_id unless all ids of a component are null. Other columns are ignored.
    """
    _, rows = join_sets(docs, id_col, text_col, **options)
    return rows.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), "component_id")


def _linked(docs: DataFrame, id_col: str, text_col: str, options: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of documents, (node, id, copies) of each different set, and all links (u, v) of sets."""
    _, rows, found, _ = _verified(docs, id_col, text_col, every=True, **options)
    classes = rows.filter("size > 0").groupBy("node").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    return rows, written(classes, "classes"), written(found, "links")


def set_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, copies, other_id, other_copies): every linked pair of different sets, once.

    A set is named by the least id of the documents that have it, and `copies` is their number;
    equal sets make no row. Links and options are those of `link_documents`. The rows of a group of
    near copies, and the work for them, grow with its number of pairs of different sets.
    """
    _, classes, found = _linked(docs, id_col, text_col, options)
    for node, name in (("u", "a"), ("v", "b")):
        found = found.join(classes.select(F.col("node").alias(node), F.struct("id", "copies").alias(name)), node)
    low, high = F.least("a", "b"), F.greatest("a", "b")
    return found.select(
        low["id"].alias("doc_id"), low["copies"].alias("copies"),
        high["id"].alias("other_id"), high["copies"].alias("other_copies"),
    )


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document the size of its n-gram set and the number of other documents it links with.

    Links are the direct ones, copies counted each; see `set_links` for their cost.
    """
    rows, classes, found = _linked(docs, id_col, text_col, options)
    both = found.union(found.select("v", "u")).toDF("node", "other")
    weights = classes.select(F.col("node").alias("other"), "copies")
    others = both.join(weights, "other").groupBy("node").agg(F.sum("copies").alias("others"))
    counts = classes.join(others, "node", "left").select(
        "node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    n = F.when(F.col("size") > 0, F.col("n_links")).otherwise(F.lit(0)).cast("bigint")
    counted = rows.join(counts, "node", "left")
    return counted.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), n.alias("n_links"))


def _keep(table: pa.Table, rows: pa.Table) -> pa.Table:
    return table.take(pa.array(np.sort(rows.column("row").to_numpy()))).drop_columns([BUCKET])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with all their columns, one of each linked group: the one with the least id.

    Documents that are linked with nothing stay, whether their ids are null, repeated or neither;
    of a group's rows that share the least id, one stays.
    """
    buckets, rows = join_sets(docs, id_col, text_col, **options)
    place = F.struct(F.col("id").isNull().alias("none"), "id", BUCKET, "row")
    group = F.when(F.col("size") == 0, F.struct(F.col(BUCKET).alias("a"), F.col("row").alias("b"))).otherwise(
        F.struct(F.lit(-1).alias("a"), F.lit(-1).alias("b"))
    )
    kept = (
        rows.groupBy("component", group.alias("group")).agg(F.min(place).alias("at")).select("at.*")
    ).select(BUCKET, "row")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return bucket_map(buckets, kept, _keep, schema, full=True)
