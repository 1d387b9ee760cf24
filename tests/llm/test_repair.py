"""Repairs against all edits of short conversations, and against one pass over whole ones."""

from __future__ import annotations

import random
import re
import zlib
from functools import lru_cache
from hashlib import sha256
from itertools import product
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from framewright.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
NEW = {"": "u", "s": "u", "u": "a", "a": "u"}


def digest(role, text):
    return sha256(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest()[:32]


def faults_of(rows):
    seen, found = set(), []
    for role, text in rows:
        bare = text.rstrip(WHITE)
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def plain_repair(rows):
    """Cost, letters and repaired lines, by a search over (row, last initial) with memory."""
    rows = [(r or " " if r is None else r, " " if t is None else t) for r, t in rows]
    faults = faults_of(rows)

    @lru_cache(None)
    def best(i, last, spare):
        options = [(0, "")] if i == len(rows) and last in ("", "a") else []
        new = NEW[last]
        if spare:
            cost, rest = best(i, new, spare - 1)
            options.append((cost + 2, "I" + rest))
        if i < len(rows):
            cost, rest = best(i + 1, last, 3)
            options.append((cost + 3, "D" + rest))
            if faults[i] not in ("blank", "duplicate"):
                late = faults[i] == "truncated"
                own = rows[i][0][:1]
                if own and (own == new or own == "s" and last == ""):
                    cost, rest = best(i + 1, own, 3)
                    options.append((cost + late, "K" + rest))
                cost, rest = best(i + 1, new, 3)
                options.append((cost + 2 + late, "R" + rest))
        return min(options) if options else (10**9, "")

    for i, spare, last in product(range(len(rows), -1, -1), range(4), NEW):
        best(i, last, spare)  # from the end, so that no call goes deep
    cost, audit = best(0, "", 3)
    lines, last, i = [], "", 0
    for edit in audit:
        role = {"u": "user", "a": "assistant"}[NEW[last]]
        if edit == "I":
            lines.append(f"{role}:")
        elif edit != "D":
            role = rows[i][0] if edit == "K" else role
            lines.append(f"{role}:{rows[i][1]}")
        i += edit != "I"
        last = last if edit == "D" else role[0]
    initials = [r[:1] for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest()


def in_order(rows):
    """Rows (turn, role, text) of a conversation in their order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1], r[2])))


def expected(rows):
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *plain_repair([(r, x) for _, r, x in in_order(rows)]))


def by_conversation(rows):
    found = {}
    for r in rows:
        found.setdefault(r[0], []).append(tuple(r[1:]))
    return found


def test_search_gives_the_least_of_all_edits():
    """The search above against every string of edits."""
    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", "", "c!"])) for _ in range(rng.randint(0, 3))]
        faults, found = faults_of(rows), []
        for size in range(len(rows) + 4):
            for audit in product("DIKR", repeat=size):
                if size - audit.count("I") != len(rows):
                    continue
                cost, i, parts = 0, 0, []
                for e in audit:
                    if e == "I":
                        parts.append("ua")
                        cost += 2
                        continue
                    if e != "D":
                        if faults[i] in ("blank", "duplicate"):
                            break
                        parts.append("ua" if e == "R" else rows[i][0][0])
                        cost += 2 * (e == "R") + (faults[i] == "truncated")
                    else:
                        cost += 3
                    i += 1
                else:
                    if any(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in product(*parts)):
                        found.append((cost, "".join(audit)))
        assert min(found) == plain_repair(rows)[4:6]


def odd_conversations():
    rng = random.Random(2)
    role = lambda: rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "superuser", "User", "", None])
    text = lambda: rng.choice([None, "", " \n", "yes.", "no", "Σίγμα!", "what?\t ", "日本", *[f"t{rng.randint(0, 9)}." for _ in range(12)]])
    turn = lambda n: rng.choice([None, rng.randint(-3, n), rng.randint(0, n)])
    rows = [(c, turn(n), role(), text()) for c in [None, *range(40)] for n in [rng.randint(1, 14)] for _ in range(n)]
    rows += [(100, i, ["user", "assistant"][rng.random() < 0.5], text()) for i in range(900)]
    return rows + rows[:5] + rows[:5]


@pytest.mark.parametrize("least", [1, 64])
def test_repair(spark, least):
    """Blocks of one row and more, checkpoints, ties, null turns, repeated rows."""
    rows = odd_conversations()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("x") for c in ("name", "kind", "block", "codes", "position", "range", "gaps", "cost")})
    got = {r.conv_id: tuple(r[1:]) for r in repair.repair(frame, least=least).collect()}
    want = {c: expected(own) for c, own in by_conversation(rows).items()}
    assert got.keys() == want.keys()
    for c in want:
        assert got[c] == want[c], c


def test_long_text_and_none(spark):
    assert repair.repair(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, 0, "user", "w " * 2_000_000 + "."), (1, 1, "assistant", "ok.")]
    got = repair.repair(spark.createDataFrame(rows, SCHEMA)).first()
    assert (got.audit, got.cost) == ("KK", 0) and got.repaired_sha256 == expected([r[1:] for r in rows])[-1]


def damaged(rows):
    text = lambda x: " " if x is None else str(x)
    found = []
    for c, t, role, words in rows:
        kind = zlib.crc32(f"{text(c)}:{text(t)}".encode()) % 20
        words = "" if kind == 1 else re.sub("[.!?]", "", text(words)) if kind == 2 else text(words)
        found += [(c, t, "user" if kind == 4 else text(role), words)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return found


def test_query(spark, tmp_path):
    """The registered query on the smallest table and on odd rows."""
    odd = spark.createDataFrame(odd_conversations(), SCHEMA)
    odd.write.parquet(f"{tmp_path}/conversations.parquet")
    for folder in ("/root/testdata/sf0.001", str(tmp_path)):
        if not Path(folder).exists():
            continue
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        own = by_conversation(damaged(rows))
        empty = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
        want = {c: expected(own[c]) if c in own else empty for c in {r[0] for r in rows}}
        got = {r.conv_id: tuple(r[1:]) for r in queries.QUERIES["op12_conversation_repair"](spark, folder).collect()}
        assert got == want
