"""Operator 11 against a plain search over whole audits."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroseries.llm import conversation_repair as C

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
FIELDS = ["conv_id", *C.FIGURES, "audit", "repaired_sha256"]


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d == 1:
            text = ""
        if d == 2:
            text = re.sub("[.!?]", "", text)
        if d == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


def order(r):
    role, text = r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " "
    return (r[1] is not None, r[1] or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())


def plain(ids, rows):
    """The contract's rows: every id with its figures, by comparing whole audits."""
    out = []
    for c in set(ids):
        own = sorted((r for r in rows if r[0] == c), key=order)
        own = [(t, " " if role is None else role, " " if text is None else text) for _, t, role, text in own]
        faults, seen = [], set()
        for _, role, text in own:
            bare = text.strip(C.SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))

        @cache
        def best(i, state, inserted):
            # (cost, audit, lines) from row i on; state: what stands before (none, s, u or a).
            found = [(0, "", ())] if i == len(own) and state in ("", "a") else []
            nxt, name = ("a", "assistant") if state == "u" else ("u", "user")
            if inserted < 3:
                cost, audit, lines = best(i, nxt, inserted + 1)
                found.append((cost + 2, "I" + audit, (name + ":", *lines)))
            if i < len(own):
                _, role, text = own[i]
                cost, audit, lines = best(i + 1, state, 0)
                found.append((cost + 3, "D" + audit, lines))
                if faults[i] not in ("blank", "duplicate"):
                    late = int(faults[i] == "truncated")
                    cost, audit, lines = best(i + 1, nxt, 0)
                    found.append((cost + 2 + late, "R" + audit, (f"{name}:{text}", *lines)))
                    first = role[:1]
                    if first == nxt or first == "s" and state == "":
                        cost, audit, lines = best(i + 1, first, 0)
                        found.append((cost + late, "K" + audit, (f"{role}:{text}", *lines)))
            return min(found) if found else (10 ** 9, "Z", ())

        for i in range(len(own), -1, -1):
            for s in ("", "s", "u", "a"):
                best(i, s, 0)
        cost, audit, lines = best(0, "", 0)
        turns = {t for t, _, _ in own if t is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(map(str, out))


def got(df):
    return sorted(map(str, map(tuple, df.select(*FIELDS).collect())))


def cases(n=120, seed=11):
    rng = random.Random(seed)
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (None, 3, "user", "Hi."), (-1, None, "system", "Be good."), (-1, None, "tool", ""), (-2, 5, "", "x"), (-2, 9, "Assistant", "y!")]
    for c in range(n):
        role = rng.choice(["system", "user"])
        for t in range(rng.randint(1, 9)):
            text = rng.choice(["Yes.", "No", " \n", "", f"Text {rng.randint(0, 999)}.", f"{rng.randint(0, 9)} e.\t \n", "　", "é漢?", None])
            rows.append((c, rng.choice([t, t, t, t + 1, None]), rng.choice([role, role, role, "system", "assistant", None, "u", "tool"]), text))
            role = {"user": "assistant"}.get(role, "user")
    return rows


def test_matches_plain(spark):
    rows = cases()
    frame = spark.createDataFrame(rows, SCHEMA)
    ids = [r[0] for r in rows]
    assert got(C.repair_figures(C.damage(frame))) == plain(ids, damaged(rows))
    assert got(C.repair_figures(frame)) == plain(ids, rows)


def test_repaired_rows_are_the_audits(spark):
    rows = cases(40, 5)
    frame = spark.createDataFrame(rows, SCHEMA)
    edits = C.repair(frame).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "edit", "role", "text"))).alias("x")).collect()
    want = {r["conv_id"]: r for r in C.repair_figures(frame).collect()}
    assert {r["conv_id"] for r in edits} == {k for k, r in want.items() if r["audit"]}
    for r in edits:
        assert "".join(e["edit"] for e in r["x"]) == want[r["conv_id"]]["audit"]
        kept = [e for e in r["x"] if e["edit"] != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(e["role"][0] for e in kept))
        assert hashlib.sha256("\n".join(f"{e['role']}:{e['text']}" for e in kept).encode()).hexdigest() == want[r["conv_id"]]["repaired_sha256"]


def test_long_conversation_and_very_long_text(spark):
    role = ["user", "assistant", "assistant"]
    rows = [(1, t, role[t % 3], f"No {t % 5000}" + "." * (t % 4 > 0)) for t in range(30_000)] + [(2, 0, "user", "x " * 1_000_000 + "?"), (2, 1, "assistant", "y.")] + [(3, 7, "user", "the same.")] * 4000
    found = {r["conv_id"]: r for r in C.repair_figures(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[1]["duplicate"] == 30_000 - 10_000 and found[1]["gaps"] == 0
    assert len(found[1]["audit"]) >= 30_000 and found[1]["audit"].count("D") >= found[1]["duplicate"]
    assert found[2]["audit"] == "KK" and found[2]["repaired_sha256"] == hashlib.sha256(("user:" + "x " * 1_000_000 + "?\nassistant:y.").encode()).hexdigest()
    assert found[3]["duplicate"] == 3999 and found[3]["cost"] == 2 + 3 * 3999 and sorted(found[3]["audit"]) == sorted("D" * 3999 + "IK")


@pytest.mark.parametrize("word", ["", "E", "I", "AEI", "EIEI", "FGHE", "MNOP", "IIIIEEEE"])
def test_graph_shares_rests(word):
    alone = C.Graph()
    want = alone.repair(word[::-1])
    shared = C.Graph()
    rests = sorted({w[::-1] for w in ["EIEI", "AEIEI", "EEIEI", "IEIEI", "EIEIEI", word]})
    assert {r: shared.repair(r) for r in rests}[word[::-1]] == want


def test_empty_and_clashing(spark):
    assert C.repair_figures(C.damage(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = cases(20, 3)
    frame = spark.createDataFrame(rows, SCHEMA)
    extra = frame.withColumns({c: F.lit("x") for c in ("digest", "letter", "kind", "audit", "gaps", "d", "word", "has_turn")})
    assert got(C.repair_figures(C.damage(extra))) == got(C.repair_figures(C.damage(frame)))
