"""Conversation repair against all edit sequences, and its faults against plain loops."""

import hashlib
import itertools
import random
import re
import time
import zlib

from seatcast.llm import dialogs, queries

CONTRACT = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, audit string, conv int, kind int"


def all_repairs(rows):
    """Every way to edit (role, fault) rows with at most two inserted rows at a place:
    (cost, audit, roles)."""
    inserts = [("", [])] + [("I", [r]) for r in "ua"] + [("II", [r, t]) for r in "ua" for t in "ua"]
    places = []
    for role, fault in rows:
        more = 3 * (fault == "truncated")
        own = [(4, "D", [])]
        if fault not in ("blank", "duplicate"):
            own += [(more, "K", [role[:1]]), (3 + more, "R", ["u"]), (3 + more, "R", ["a"])]
        places += [[(3 * len(a), a, r) for a, r in inserts], own]
    places.append([(3 * len(a), a, r) for a, r in inserts])
    for combo in itertools.product(*places):
        yield (sum(c for c, _, _ in combo), "".join(a for _, a, _ in combo),
               "".join(x or "-" for _, _, r in combo for x in r))


def cheapest(rows):
    """(cost, audit) by trying everything."""
    return min((c, a) for c, a, roles in all_repairs(rows) if CONTRACT.fullmatch(roles))


def faults(rows):
    """The first fault of each (role, text) row."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen
                   else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_solve(rows):
    """Least (cost, audit) step by step: costs to go from the end, then greedily."""
    ends, edits = {0: 0, 1: 6, 2: 3, 3: 0}, []
    step = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    togo = [ends]
    for role, fault in reversed(rows):
        own, more = {}, 3 * (fault == "truncated")
        for q in range(4):
            own[q] = [("D", 4, q)]
            if fault not in ("blank", "duplicate"):
                if (role[:1], q) in step:
                    own[q].append(("K", more, step[role[:1], q]))
                own[q].append(("R", 3 + more, 3 if q == 2 else 2))
        edits.append(own)
        v = {q: min(c + togo[-1][t] for _, c, t in own[q]) for q in range(4)}
        for _ in range(3):
            v = {q: min(v[q], 3 + v[3 if q == 2 else 2]) for q in range(4)}
        togo.append(v)
    audit, q = "", 0
    for k in range(len(rows), 0, -1):
        while True:
            fits = {e: t for e, c, t in edits[k - 1][q] if c + togo[k - 1][t] == togo[k][q]}
            if 3 + togo[k][3 if q == 2 else 2] == togo[k][q]:
                fits["I"] = 3 if q == 2 else 2
            audit += min(fits)
            q = fits[min(fits)]
            if audit[-1] != "I":
                break
    while q in (1, 2):
        audit, q = audit + "I", q + 1
    return togo[-1][0], audit


def repaired(rows, audit):
    """The repaired (role, text) rows, the roles from the audit."""
    out, at, last = [], 0, ""
    for edit in audit:
        new = "assistant" if last == "u" else "user"
        if edit == "I":
            out.append((new, ""))
        else:
            role, text = rows[at]
            at += 1
            if edit == "D":
                continue
            out.append((role if edit == "K" else new, text))
        last = out[-1][0][:1]
    return out


def expected(conversations):
    out = {}
    for conv, rows in conversations.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1],
                                           hashlib.sha256(r[2].encode()).digest()))
        said = [(role, text) for _, role, text in rows]
        found = faults(said)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [role[:1] for role, _ in said]
        cost, audit = plain_solve([(r, f) for (r, _), f in zip(said, found)])
        lines = "\n".join(f"{r}:{t}" for r, t in repaired(said, audit))
        out[conv] = (gaps, found.count("blank"), found.count("duplicate"),
                     found.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return out


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        conv_text, turn_text, role, text = (" " if x is None else x
                                            for x in (conv, turn, role, text))
        own = out.setdefault(conv, [])
        k = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        own += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def symbols(rows):
    """Run-length symbols of (role, fault) rows."""
    out = []
    for role, fault in rows:
        kind = "sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3
        s = dialogs.GONE if fault in ("blank", "duplicate") else kind + 4 * (fault == "truncated")
        if out and out[-1][0] == s:
            out[-1] = s, out[-1][1] + 1
        else:
            out.append((s, 1))
    return out


def random_rows(rnd, n):
    same = rnd.random() < 0.3
    row = None
    out = []
    for _ in range(n):
        if row is None or not same or rnd.random() < 0.2:
            row = (rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]),
                   rnd.choice(["", "", "", "blank", "duplicate", "truncated"]))
        out.append(row)
    return out


def test_cheapest_edits_by_trying_all():
    rnd = random.Random(5)
    for n in (0, 1, 1, 2, 2, 2, 3, 3) * 12:
        rows = random_rows(rnd, n)
        assert dialogs.solve(symbols(rows)) == cheapest(rows) == plain_solve(rows), rows


def test_cheapest_edits_step_by_step():
    rnd = random.Random(6)
    for _ in range(1500):
        rows = random_rows(rnd, rnd.randint(0, 12) if rnd.random() < 0.9 else 300)
        assert dialogs.solve(symbols(rows)) == plain_solve(rows), rows


def test_long_runs_cost_what_their_length_says():
    t = time.time()
    cost, audit = dialogs.solve([(1, 300_000), (2, 1), (dialogs.GONE, 200_000)])
    assert time.time() - t < 30 and audit.count("D") >= 200_000
    assert (cost, audit) == plain_solve([("user", "")] * 300_000 + [("assistant", "")]
                                        + [("", "blank")] * 200_000)


def _check(spark, rows, **names):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    conversations = {}
    for conv, turn, role, text in rows:
        conversations.setdefault(conv, []).append(
            (turn, " " if role is None else role, " " if text is None else text))
    got = dialogs.repair_report(df).collect()
    want = expected(conversations)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in dialogs.audits(df).collect()} == {
        k: v[:-1] for k, v in want.items()}
    rows_out = {}
    for r in sorted(dialogs.repair(df).collect(), key=lambda r: (str(r.conv_id), r.position)):
        rows_out.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, row in want.items():
        text = "\n".join(rows_out.get(conv, []))
        assert hashlib.sha256(text.encode()).hexdigest() == row[-1]


def test_nulls_ties_repeats_and_odd_roles(spark):
    _check(spark, [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Hello."),
        (2, None, None, None), (2, None, "user", "a."), (2, 3, "tool", "x."), (2, 9, "user", "a."),
        (None, 1, "user", "q?"), (None, 1, "user", "q?"), (None, 1, "assistant", "no end"),
        (3, 5, "", "t."), (3, 5, "user", " \t\n\x0b\x0c\r"), (3, -7, "sage", "t.\u0085"),
        (3, 5, "user", "b."), (3, 5, "user", "a."), (4, 1, "assistant", "only."),
        (5, 2 ** 62, "user", "é!"), (5, -4, "user", "é! \n"), (6, 0, "system", "s.")])


def test_blocks_join(spark):
    """A conversation over several blocks, with repeats across them."""
    rnd = random.Random(7)
    rows = [(1, t * 700, rnd.choice(["user", "assistant"]), rnd.choice(["a.", "b", "", f"{t}."]))
            for t in range(60)]
    rows += [(c, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b", f"{t}?"]))
             for c in range(2, 30) for t in range(rnd.randint(1, 9))]
    _check(spark, rows)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert dialogs.repair_report(df).collect() == [] and dialogs.repair(df).collect() == []


def test_query_by_plain_loops(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_conversation_repair(spark, "/root/testdata/sf0.01").collect()
    want = expected(damaged(rows))
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_query_keeps_conversations_that_lost_all_rows(spark, tmp_path):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    null = [(None, None, None, None), (None, 1, "user", "Hm.")]
    spark.createDataFrame([(lost, 0, "user", "Hi."), *null],
                          "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r)[1:] for r in queries.op12_conversation_repair(
        spark, str(tmp_path)).collect()}
    assert got == expected(damaged([(lost, 0, "user", "Hi."), *null]))
    assert got[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
