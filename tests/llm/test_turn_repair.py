"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from creamline.llm import turn_repair
from creamline.llm.turn_repair import BlockTables, kind_of

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
LEGAL = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
ROW = "conv_id long, turn long, role string, text string"


def plain_edits(rows):
    """(cost, edits) of rows (initial, must go, cut off): the cheapest, then the ASCII-least."""
    @cache
    def best(at, state, inserts):
        ways = []
        if at == len(rows) and state in ("", "a"):
            ways.append((0, ""))
        if inserts:
            cost, text = best(at, NEXT[state], inserts - 1)
            ways.append((2 + cost, "I" + text))
        if at < len(rows):
            initial, must_go, cut_off = rows[at]
            cost, text = best(at + 1, state, 3)
            ways.append((3 + cost, "D" + text))
            if not must_go:
                if (state, initial) in LEGAL:
                    cost, text = best(at + 1, LEGAL[state, initial], 3)
                    ways.append((cut_off + cost, "K" + text))
                cost, text = best(at + 1, NEXT[state], 3)
                ways.append((2 + cut_off + cost, "R" + text))
        return min(ways, default=(10**9, ""))

    return best(0, "", 3)


@pytest.mark.parametrize("length", [1, 2, 3])
def test_blocks_give_the_least_of_the_cheapest_edits(length):
    rng, tables = random.Random(length), BlockTables(length)
    for _ in range(1500):
        rows = [(rng.choice("suax"), rng.random() < 0.2, int(rng.random() < 0.3)) for _ in range(rng.randint(0, 9))]
        kinds = bytes(8 if gone else kind_of(initial, cut) for initial, gone, cut in rows)
        edits, cost = tables.edits(kinds)
        assert (cost, edits) == plain_edits(tuple(rows))


def test_vectors_stay_few():
    assert len(turn_repair.tables().vectors) < 100


def plain_report(rows):
    """The contract's row of each conversation, by rows (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept, own = [], sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        for _, turn, role, text in own:
            role, text = " " if role is None else role, " " if text is None else text
            what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if what == 1:
                text = ""
            elif what == 2:
                text = re.sub("[.!?]", "", text)
            elif what == 4:
                role = "user"
            kept += [(turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        blank = duplicate = truncated = 0
        seen, facts = set(), []
        for _, role, text in kept:
            bare = re.findall(r"[^\x20\x09-\x0D]", text)
            must_go, cut = not bare or (role, text) in seen, False
            if not bare:
                blank += 1
            elif must_go:
                duplicate += 1
            elif bare[-1] not in ".!?":
                truncated, cut = truncated + 1, True
            seen.add((role, text))
            facts.append((role[:1], must_go, int(cut)))
        initials = [f[0] for f in facts]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        turns = {t for t, _, _ in kept if t is not None}
        cost, edits = plain_edits(tuple(facts))
        left, final, state = iter(kept), [], ""
        for edit in edits:
            _, role, text = (None, "", "") if edit == "I" else next(left)
            if edit == "D":
                continue
            if edit == "K":
                state = role[:1]
            else:
                state = NEXT[state]
                role = {"u": "user", "a": "assistant"}[state]
            final.append(f"{role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, blank, duplicate, truncated, illegal, cost, edits, hashlib.sha256("\n".join(final).encode()).hexdigest())
    return out


def odd_rows():
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(120)]:
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Hi.", "Well", "Yes!", "", " \n", None, "Né 日本?", "x" * 5000 + "."])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 3]), role, text))
    return rows + [rows[3], rows[3], (500, 1, "user", "a."), (500, 2, "user", "a.")]


def test_report_equals_a_plain_one(spark):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, ROW).selectExpr("*", "1 AS kind", "'z' AS said", "2 AS copies")
    got = {r[0]: tuple(r[1:]) for r in turn_repair.audits(turn_repair.damaged(frame)).collect()}
    assert got == plain_report(rows)


def test_repaired_rows_are_legal_and_hash_like_the_report(spark):
    frame = turn_repair.damaged(spark.createDataFrame(odd_rows(), ROW))
    texts, initials = {}, {}
    for r in turn_repair.repaired(frame).orderBy("conv_id", "place").collect():
        if r.edit != "D":
            texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
            initials[r.conv_id] = initials.get(r.conv_id, "") + r.role[0]
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in initials.values())
    for r in turn_repair.audits(frame).collect():
        assert r.repaired_sha256 == hashlib.sha256("\n".join(texts.get(r.conv_id, [])).encode()).hexdigest()


def test_a_conversation_beyond_memory_waits_in_a_file(spark, monkeypatch):
    monkeypatch.setattr(turn_repair._Turns, "MOST_CHARS", 40)
    turns = turn_repair._Turns(1)
    rows = [(t, "user" if t % 2 == 0 else "assistant", f"Line {t}.") for t in range(50)]
    for row in rows:
        turns.add(*row, False)
    assert [r[1:] for r in turns.repaired()] == rows and turns.audit == "K" * 50


def test_no_rows(spark):
    assert turn_repair.audits(turn_repair.damaged(spark.createDataFrame([], ROW))).collect() == []
