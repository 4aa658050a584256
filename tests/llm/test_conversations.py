import hashlib
import itertools
import random
import re
import zlib

import pytest

from strata.llm.conversations import at_end, before, contexts, damage, repair_report, repaired_rows
from strata.llm.queries import QUERIES

GRAMMAR = re.compile("(s?(ua)+)?")
INITIAL = {"user": "u", "assistant": "a", "system": "s"}


def identity(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def least_repair(rows, found):
    """Forward search over (state, last edits): the least (cost, audit, lines)."""
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}

    def spread(level):
        while True:
            new = dict(level)
            for state, (cost, audit, lines) in level.items():
                for role in ("user", "assistant"):
                    to = follow.get((state, role[0]))
                    if to:
                        new[to] = min(new.get(to, (9e9,)), (cost + 2, audit + "I", lines + (role + ":",)))
            if new == level:
                return level
            level = new

    best = spread(best)
    for (_, role, text), fault in zip(rows, found, strict=True):
        after = {}

        def offer(to, price, after=after):
            if to is not None and price < after.get(to, (9e9,)):
                after[to] = price

        for state, (cost, audit, lines) in best.items():
            offer(state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            off = fault == "truncated"
            offer(follow.get((state, role[:1])), (cost + off, audit + "K", lines + (f"{role}:{text}",)))
            for told in ("user", "assistant"):
                offer(follow.get((state, told[0])), (cost + off + 2, audit + "R", lines + (f"{told}:{text}",)))
        best = spread(after)
    return min(best[s] for s in ("", "a") if s in best)


def brute(rows):
    """rows: (turn, role, text) after damage, nulls replaced but for turns."""
    rows = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), r[1], identity(r[1], r[2])))
    found = faults(rows)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    cost, audit, lines = least_repair(rows, found)
    assert GRAMMAR.fullmatch("".join(x[0] for x in lines))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, found.count("blank"), found.count("duplicate"), found.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def told(report):
    return {r.conv_id: tuple(r)[1:] for r in report.collect()}


def conversations(seed, n, longest):
    rng = random.Random(seed)
    out = []
    for conv in range(n):
        for k in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 3 + ["system", "tool", "", "User", "attendant"])
            text = rng.choice(["Yes.", "Well", "Go!", "", " \t", "Is it? ", "é…", f"No {rng.randint(0, 9)}."])
            turn = rng.choice([k, k, k, k + 2, None, max(k - 1, 0)])
            out.append((conv, turn, role, text))
    return out


def by_conversation(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return groups


@pytest.mark.parametrize("block,longest", [(512, 9), (1, 9), (3, 12), (7, 60)])
def test_against_brute_force(spark, block, longest):
    rows = conversations(block, 60, longest)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert told(repair_report(df, block)) == {c: brute(r) for c, r in by_conversation(rows).items()}


def test_every_short_signature():
    """The least cost of all strings of up to four symbols, by brute force over the same symbols."""
    roles, level = ["system", "user", "assistant", "tool"], {(): at_end()}
    for _ in range(4):
        level = {(symbol, *word): before(symbol, after) for word, after in level.items() for symbol in range(9)}
        for word, (cost, audit, _end) in random.Random(1).sample(sorted(level.items()), min(300, len(level))):
            rows = [(k, roles[s % 4], f"{k}" + ("" if s >= 4 else ".")) if s < 8 else (k, "user", "") for k, s in enumerate(word)]
            assert (cost[0], audit[0]) == least_repair(rows, faults(rows))[:2]


def test_contexts_are_few():
    vectors, moves = contexts()
    assert len(vectors) < 100 and len(moves) == len(vectors) * 9


def test_query_against_brute_force(spark, sf):
    given = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    after = {}
    for r in given:
        rows = after.setdefault(r.conv_id, [])
        fault = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", r.text) if fault == 2 else r.text
        rows += [(r.turn, "user" if fault == 4 else r.role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert told(QUERIES["op11_conversation_repair"](spark, sf)) == {c: brute(r) if r else nothing for c, r in after.items()}


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (1, None, None, None), (1, None, "user", "Hi."), (1, 5, "assistant", None),
            (2, 0, None, "x."), (3, 0, "user", "A."), (3, 0, "user", "A."), (3, 0, "assistant", "B"), (3, 0, "assistant", "B"), (4, 7, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS symbol", "'x' AS digest")
    expected = {c: brute(r) for c, r in by_conversation(rows).items()}
    assert told(repair_report(df)) == expected and expected[4][6] == "D" and expected[None][6] == "KK"
    assert repair_report(df.limit(0)).count() == 0 and repaired_rows(df.limit(0)).count() == 0


def test_damage_of_nulls_and_repaired_rows(spark):
    df = spark.createDataFrame([(None, None, None, None)] * 2, "conv_id long, turn long, role string, text string")
    fault = zlib.crc32(b" : ") % 20
    assert damage(df).count() == {0: 0, 3: 4}.get(fault, 2)
    df = spark.createDataFrame([(1, 0, "assistant", "A."), (1, 1, "assistant", "B."), (1, 2, "user", "C")], "conv_id long, turn long, role string, text string")
    lines = sorted((r.at, r.edit, r.role, r.text) for r in repaired_rows(df).collect())
    assert [x[2] for x in lines] == ["user", "assistant"] * (len(lines) // 2) and told(repair_report(df))[1][-1] == hashlib.sha256(
        "\n".join(f"{r}:{t}" for _, _, r, t in lines).encode()).hexdigest()


def test_long_conversation_and_long_text(spark):
    rows = [(1, k, ("user", "assistant")[k % 2 if k % 17 else 0], f"{k}." if k % 5 else f"{k}") for k in range(3000)]
    rows += [(2, 0, "user", "word " * 400_000 + "."), (2, 1, "assistant", "x" * 1_000_000)] + [(3, 0, "user", "Again.")] * 2000
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    assert told(repair_report(df)) == {c: brute(r) for c, r in by_conversation(rows).items()}
