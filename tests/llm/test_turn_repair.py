"""Conversation repair against the enumeration of all edits, and long conversations against short ones."""

import hashlib
import itertools
import random
import re
import zlib

from ordermart.llm import queries, turn_repair as tr
from ordermart.llm.common import corpus_session

SPACES = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = [c for c in text if c not in SPACES]
        out.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def enumerate_edits(rows):
    """rows (role, text) -> least (cost, audit, lines) over every choice of edits and up to two inserts in each place."""
    found, marks = None, faults(rows)
    gaps = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    per_row = [[("D", 4, [])] if m in ("b", "d") else
               [("D", 4, []), ("K", 3 * (m == "t"), [(r, t)])] + [("R", 3 + 3 * (m == "t"), [(x, t)]) for x in ("user", "assistant")]
               for (r, t), m in zip(rows, marks)]
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product(*per_row):
            cost = 3 * sum(map(len, inserts)) + sum(e[1] for e in edits)
            if found and cost > found[0]:
                continue
            audit, lines = "", []
            for ins, e in itertools.zip_longest(inserts, edits):
                audit += "I" * len(ins) + (e[0] if e else "")
                lines += [(x, "") for x in ins] + (e[2] if e else [])
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in lines)):
                best = (cost, audit, [f"{r}:{t}" for r, t in lines])
                found = best if found is None else min(found, best)
    return found


def summary(rows):
    """rows (turn, role, text) in order -> counts before the edits."""
    marks, signs = faults([r[1:] for r in rows]), [r[1][:1] for r in rows]
    turns = {t for t, _, _ in rows if t is not None}
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, marks.count("b"), marks.count("d"), marks.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(signs, signs[1:])))


def spaced(rows):
    return sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def run(spark, conversations, **kw):
    corpus_session(spark)
    rows = [(c, *r, "x") for c, group in conversations for r in group]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string").repartition(3)
    return {r["conv_id"]: tuple(r)[1:] for r in tr.digest(tr.repair(df, **kw)).collect()}


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Hi.", "Yes!", "No?", "cut off", " \t", "", None, "End. \n", "end, "]
    return [(rng.choice([None, 1, 2, 3, 5, 9]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_every_choice_of_edits(spark):
    rng = random.Random(3)
    conversations = [(c if c else None, random_rows(rng, rng.randrange(1, 4))) for c in range(60)]
    conversations += [(900, [(1, "user", "a."), (2, "user", "b."), (3, "assistant", "c."), (4, "assistant", "d.")]),
                      (901, [(1, "assistant", "a."), (2, "system", "b."), (3, "user", "c")])]
    got = run(spark, conversations)
    assert len(got) == len(conversations)
    for c, rows in conversations:
        rows = spaced(rows)
        cost, audit, lines = enumerate_edits([r[1:] for r in rows])
        assert got[c] == (*summary(rows), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), rows


def test_long_conversations_are_cut_and_give_the_same(spark):
    rng = random.Random(5)
    conversations = [(1, random_rows(rng, 400)), (None, [(None, None, None)] * 300 + random_rows(rng, 40)),
                     (2, [(i, ["user", "assistant"][i % 2], f"turn {i}.") for i in range(101)]), (3, random_rows(rng, 5)),
                     (4, [(0, "user", "w" * 5000)]), (5, [(i % 7, "system", "S.") for i in range(90)])]
    whole = run(spark, conversations)
    assert run(spark, conversations, limit_rows=7) == whole
    assert run(spark, conversations, limit_rows=50, limit_bytes=1000) == whole


def plain(rows):
    """The same search with whole audits as strings, minimum per top."""
    best = {0: (0, "")}
    for (role, _), m in zip(rows, faults(rows)):
        new = {}
        for top, (cost, audit) in best.items():
            for n in range(3):
                at = tr.inserted(top, n)[0]
                for letter, more, to in [("D", 4, at)] + ([] if m in ("b", "d") else [
                        *(("K", 3 * (m == "t"), t) for (a, s), t in tr.SHIFT.items() if a == at and s == role[:1]),
                        *(("R", 3 + 3 * (m == "t"), t) for (a, s), t in tr.SHIFT.items() if a == at and s in "ua")]):
                    found = (cost + 3 * n + more, audit + "I" * n + letter)
                    new[to] = min(new.get(to, found), found)
        best = new
    return min((c + 3 * n, a + "I" * n) for top, (c, a) in best.items() for n in range(3) if tr.inserted(top, n)[0] in (0, 3))


def test_ranks_order_audits_like_the_strings(spark):
    rng = random.Random(6)
    for _ in range(300):
        rows = [(r or " ", x or " ") for _, r, x in random_rows(rng, rng.randrange(0, 30))]
        assert tr.repair_one([(None, *r) for r in rows])[5:7] == plain(rows)


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in (0, 1, None)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (c, t))
        kind, role, text = zlib.crc32(key.encode()) % 20, role or " ", text or " "
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        want += [(c, t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in tr.damage(df).collect())


def test_query_on_odd_tables(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string, gaps string"
    for i, rows in enumerate(([], [(7, None, None, None, "x"), (None, None, "user", "a.", None), (None, 1, "user", "a.", None)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{i}/conversations.parquet")
        got = queries.op12_turn_repair(spark, f"{tmp_path}/{i}").collect()
        assert {r["conv_id"] for r in got} == {r[0] for r in rows} and len(got) == len({r[0] for r in rows})
