"""Repair of conversations against all edits tried one by one."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from tillwatch.llm import repair
from tillwatch.llm.queries import QUERIES

FORM = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """First fault of each (turn, role, text) row."""
    seen, out = set(), []
    for _, role, text in rows:
        held = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not held else "duplicate" if (role, text) in seen else "" if held[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows):
    """(cost, audit, repaired) of the cheapest edits, by the least string for every role sequence reached so far."""
    best = {"": (0, "", [])}  # roles so far, with all that is dear or late left out below

    def put(ways, roles, way):
        if re.fullmatch(r"s?(ua)*u?", roles):
            # Only the end matters for what may follow.
            end = roles[-1:]
            key = next((k for k in ways if k[-1:] == end), None)
            if key is None or way[:2] < ways[key][:2]:
                if key is not None:
                    del ways[key]
                ways[roles] = way

    for (_, role, text), fault in zip(rows, faults(rows)):
        after = {}
        for roles, (cost, letters, done) in inserted_all(best):
            put(after, roles, (cost + 4, letters + "D", done))
            if fault in ("blank", "duplicate"):
                continue
            own = 3 if fault == "truncated" else 0
            put(after, roles + (role[:1] or "?"), (cost + own, letters + "K", [*done, (role, text)]))
            for new in ("user", "assistant"):
                put(after, roles + new[0], (cost + own + 3, letters + "R", [*done, (new, text)]))
        best = after
    ends = [way for roles, way in inserted_all(best) if FORM.fullmatch(roles)]
    return min(ends, key=lambda w: w[:2])


def inserted_all(ways):
    """Every way with zero to two insertions after it."""
    for roles, (cost, letters, done) in ways.items():
        for n in range(3):
            for new in product(("user", "assistant"), repeat=n):
                longer = roles + "".join(r[0] for r in new)
                if re.fullmatch(r"s?(ua)*u?", longer):
                    yield longer, (cost + 3 * n, letters + "I" * n, [*done, *[(r, "") for r in new]])


def every_edit(codes):
    """Least (cost, audit) over all edits of a few rows, given as codes."""
    best = None
    ways = [[w for w in "DKR" if w == "D" or code < repair.BLANK] for code in codes]
    for letters in product(*ways):
        for gaps in product(range(3), repeat=len(codes) + 1):
            roles, audit, cost = [""], "", 3 * sum(gaps)
            for i, n in enumerate(gaps):
                roles = [r + x for r in roles for x in map("".join, product("ua", repeat=n))]
                audit += "I" * n
                if i < len(codes):
                    audit += letters[i]
                    own = 3 if codes[i] >= repair.CUT else 0
                    if letters[i] == "D":
                        cost += 4
                    elif letters[i] == "K":
                        cost += own
                        roles = [r + "?sua"[codes[i] % 4] for r in roles]
                    else:
                        cost += own + 3
                        roles = [r + x for r in roles for x in "ua"]
            if (best is None or (cost, audit) < best) and any(FORM.fullmatch(r) for r in roles):
                best = (cost, audit)
    return best


def test_audits_against_every_edit():
    for n in (0, 1, 2):
        for codes in product(range(16), repeat=n):
            assert repair.audit(bytes(codes)) == tuple(reversed(every_edit(codes))), codes
    rng = random.Random(5)
    for _ in range(25):
        codes = [rng.choice([0, 1, 2, 2, 3, 3, 5, 6, 7, 10]) for _ in range(3)]
        assert repair.audit(bytes(codes)) == tuple(reversed(every_edit(codes))), codes


def random_rows(rng, n):
    texts = ["Yes.", "No!", "A question?", "cut off", "", " \t", "Wait… what", "Fine. "]
    return [(rng.choice([None, *range(n)]), rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(texts))
            for _ in range(n)]


def in_order(rows):
    """By turn, null first, then role and hash of the text."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))


def plain(rows):
    """The contract's columns for the rows of one conversation."""
    rows = in_order([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows])
    turns = [t for t, _, _ in rows if t is not None]
    found = faults(rows)
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, done = cheapest(rows)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"), found.count("duplicate"),
        found.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest())


COLUMNS = [*repair.COUNTS, "audit", "repaired_sha256"]


@pytest.mark.parametrize("ranges", [1, 9])
def test_reports_against_plain_versions(spark, ranges):
    rng = random.Random(ranges)
    given = [(conv, *row) for conv in (None, *range(30)) for row in random_rows(rng, rng.randint(1, 9))]
    given += [(99, *row) for row in random_rows(rng, 400)]  # cut into pieces where there are ranges
    given += [(98, 7, None, None), (98, 7, None, None), (97, None, "user", "Hi."), (97, None, "assistant", "Hi.")]
    rows = spark.createDataFrame(given, "conv_id long, turn long, role string, text string").repartition(3)
    ids = spark.createDataFrame([(1000,), (5,), (None,)], "conv_id long")
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair.report(rows, ids, ranges).collect()}
    expected = {conv: plain([r[1:] for r in given if r[0] == conv]) for conv in {r[0] for r in given}}
    expected[1000] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == expected


def test_a_long_conversation_is_cut_and_its_repaired_rows_come_in_order(spark):
    rng = random.Random(2)
    given = [(1, i, rng.choice(["user", "assistant"]), f"Row {i}.") for i in range(3000)]
    rows = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    narrow = repair.coded(repair.prepared(rows))
    assert repair.pieces(narrow, 10).count() > 5
    done = repair.repaired(rows, 10).orderBy("place").collect()
    _, _, expected = cheapest([r[1:] for r in given])
    assert [(r.role, r.text) for r in done] == expected and [r.place for r in done] == list(range(len(done)))


def test_query_against_plain_damage_and_repair(spark, small):
    given = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    rows = {conv: [] for conv, _, _, _ in given}
    for conv, turn, role, text in given:
        damage = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if damage == 0:
            continue
        text = "" if damage == 1 else re.sub(r"[.!?]", "", text) if damage == 2 else text
        rows[conv] += [(turn, "user" if damage == 4 else role, text)] * (2 if damage == 3 else 1)
    got = QUERIES["op12_repair_conversations"](spark, small)
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got.collect()} == {c: plain(r) for c, r in rows.items()}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "conv_id string, turn long, role string, text string, audit string")
    assert repair.report(none, none).count() == 0 and repair.repaired(none).count() == 0
    assert repair.report(repair.damaged(none), none).columns == ["conv_id", *COLUMNS]
