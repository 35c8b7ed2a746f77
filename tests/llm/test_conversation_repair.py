"""Conversation repair against trying all edits, with pieces of any size."""

import random

import pytest

from chronoloom.llm import conversation_repair as C
from tests.llm import plain

SCHEMA = "conv_id bigint, turn int, role string, text string, n bigint, start int, edits string"


def conversations():
    rnd = random.Random(4)
    texts = ["Yes.", "No!", "cut off", "Why?", "", " \t", None, "Long one. Yes", "é…", "A."]
    out = []
    for conv in [None, *range(60)]:
        for turn in range(rnd.randint(1, 14)):
            role = rnd.choice(["user", "assistant"] * 4 + ["system", "tool", None, "", "User"])
            row = (conv, rnd.choice([turn] * 9 + [None, turn + 3]), role, rnd.choice(texts) if rnd.random() < 0.4 else f"Text {rnd.random()}.")
            out += [row] * rnd.choice([1, 1, 1, 1, 3])
    for turn in range(300):
        out.append((1000, turn, ("user", "assistant")[turn % 2], f"Line {turn}." if rnd.random() < 0.8 else "ok"))
    out += [(1001, 5, "user", "same.")] * 90 + [(1002, None, None, None)] * 7
    return out


@pytest.fixture(scope="module")
def turns():
    return conversations()


def frame(spark, turns):
    return spark.createDataFrame([(*t, 9, 9, "x") for t in turns], SCHEMA)


@pytest.mark.parametrize("piece, piece_bytes", [(C.PIECE, C.PIECE_BYTES), (1, 1), (7, 100)])
def test_all_edits(spark, turns, piece, piece_bytes):
    got = C.repair(C.damage(frame(spark, turns)), piece, piece_bytes).collect()
    want = {c: plain.repair(rows) for c, rows in plain.damaged(turns).items()}
    assert len(got) == len(want)
    assert {r[0]: tuple(r)[1:] for r in got} == want


def test_dropped_whole_and_empty(spark):
    gone = next(i for i in range(1000) if not plain.damaged([(i, 0, "user", "x.")])[i])
    turns = [(gone, 0, "user", "x."), (gone, 0, "user", "y.")]
    for piece in (C.PIECE, 1):
        (row,) = C.repair(C.damage(frame(spark, turns)), piece).collect()
        assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", plain.sha(""))
    assert C.repair(C.damage(frame(spark, []))).collect() == []
    assert C.repaired_turns(C.damage(frame(spark, []))).collect() == []


@pytest.mark.parametrize("piece", [C.PIECE, 4])
def test_repaired_turns(spark, turns, piece):
    rows = C.repaired_turns(C.damage(frame(spark, turns)), piece).collect()
    texts = {c: [] for c in plain.damaged(turns)}
    for r in sorted(rows, key=lambda r: (r.seg, r.place)):
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    want = {c: plain.repair(rows)[-1] for c, rows in plain.damaged(turns).items()}
    assert {c: plain.sha("\n".join(x)) for c, x in texts.items()} == want


def test_nodes_are_made_once():
    """Sorted from their ends, signatures cost as many nodes as they have different suffixes."""
    rnd = random.Random(1)
    signatures = sorted({"".join(rnd.choice("uaUAxs") for _ in range(rnd.randint(0, 7))) for _ in range(800)})
    automaton = C.Automaton()
    best = [automaton.read(C.END, s) for s in sorted(signatures * 3)]
    assert automaton.made == len({s[:k] for s in signatures for k in range(1, len(s) + 1)})
    assert all(n.last[0] in (0, 3) for n in best)


def test_very_long_texts(spark):
    turns = [(1, 0, "user", "a" * 3_000_000 + "."), (1, 1, "assistant", "b" * 3_000_000 + "."), (2, 0, "user", "hi.")]
    got = C.repair(C.damage(frame(spark, turns)), piece_bytes=1 << 20).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {c: plain.repair(x) for c, x in plain.damaged(turns).items()}
