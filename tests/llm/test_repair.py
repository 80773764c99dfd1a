"""Conversation repair against a search over all edits."""

import random
import re
from hashlib import sha256
from itertools import product
from zlib import crc32

import pytest

from tidegauge.llm import repair

LEGAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """Of each (role, text) in order: blank, duplicate, truncated or None."""
    out, seen = [], set()
    for row in rows:
        ink = re.sub(r"[ \t-\r]", "", row[1])
        out.append("blank" if not ink else "duplicate" if row in seen else "truncated" if ink[-1] not in ".!?" else None)
        seen.add(row)
    return out


def search(rows):
    """Cost, audit and repaired turns: every edit of every row, with inserts between, tried."""
    kinds = faults(rows)
    edits = [[("D", 3, [])] for _ in rows]
    for (role, text), kind, e in zip(rows, kinds, edits):
        if kind not in ("blank", "duplicate"):
            more = kind == "truncated"
            e += [("K", more, [(role, text)]), ("R", 2 + more, [("user", text)]), ("R", 2 + more, [("assistant", text)])]
    gap = [("I" * n, 2 * n, list(p)) for n in range(3) for p in product([("user", ""), ("assistant", "")], repeat=n)]
    steps = [gap]
    for e in edits:
        steps += [e, gap]
    # One best way for every repaired prefix's initials and state: all prefixes, kept by what was written.
    ways = {(): (0, "", [])}
    for step in steps:
        new = {}
        for key, (cost, audit, turns) in ways.items():
            for name, price, said in step:
                more = key + tuple(r[:1] or "?" for r, _ in said)
                if not re.fullmatch(r"s?(ua)*u?", "".join(more)):
                    continue
                way = (cost + price, audit + name, turns + said)
                if more not in new or way[:2] < new[more][:2]:
                    new[more] = way
        ways = new
    cost, audit, turns = min((w for k, w in ways.items() if LEGAL.fullmatch("".join(k))), key=lambda w: w[:2])
    return cost, audit, turns


def brute(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of (turn, role, text) in order."""
    turns = {t for t, _, _ in rows if t is not None}
    said = [(r, x) for _, r, x in rows]
    kinds = faults(said)
    initials = [r[:1] for r, _ in said]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, repaired = search(said)
    digest = sha256("\n".join(f"{r}:{x}" for r, x in repaired).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def brute_all(rows):
    """The same of damaged rows (conv_id, turn, role, text), by conversation; the last field of a row tells if it was kept."""
    by = {}
    for conv, turn, role, text, kept in rows:
        if kept:
            by.setdefault(conv, []).append((turn, role, text))
        else:
            by.setdefault(conv, [])
    return {c: brute(sorted(r, key=lambda x: (x[0] is not None, x[0] or 0))) for c, r in by.items()}


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        lot = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        out += [(conv, turn, "user" if lot == 4 else role, text, lot != 0)] * (2 if lot == 3 else 1)
    return out


SCHEMA = "conv_id long, turn long, role string, text string"
ROLES = ["user", "assistant", "user", "assistant", "system", "tool", "", " ", "Ab", None]
SAID = ["yes.", "no!", "why? ", "cut off", "", " \t\n", None, "yes.", "ende. ", "😀."]


def drawn(seed, convs, most):
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(draw.randrange(most + 1)):
            rows.append((c, t + draw.randrange(2) * (t > 2), draw.choice(ROLES), draw.choice(SAID) if draw.random() < 0.5 else f"text {t}."))
    # One row a turn, so that the order is that of the turns.
    return list({r[:2]: r for r in rows}.values())


def records(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_search_over_all_edits(spark, seed):
    rows = drawn(seed, 120, 7)
    said = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute_all(brute_damage(rows))
    assert records(repair.repair_report(repair.damaged(said))) == want
    # Undamaged rows, cut into stretches of one to three rows.
    plain = brute_all([(*r[:2], *(" " if x is None else x for x in r[2:]), True) for r in rows])
    for n in (1, 3):
        assert records(repair.repair_report(said, stretch=n)) == plain


def test_a_long_conversation_over_many_ranges(spark):
    draw = random.Random(5)
    rows = [(1, t, draw.choice(["user", "assistant", "assistant", "system"]), f"t{t % 700}" + draw.choice([".", ""])) for t in range(1400)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for c in (0, 2) for t in range(4)]
    said = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut, whole = (records(repair.repair_report(said.repartition(6), stretch=n)) for n in (37, 100_000))
        ranges = repair.sorted_rows(said).selectExpr("row >> 33 AS r").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranges > 5 and cut == whole
    assert cut[0] == cut[2] == (0, 0, 0, 0, 0, 0, "KKKK", sha256("\n".join(f"{r}:{x}" for _, _, r, x in rows[-4:]).encode()).hexdigest())
    # The audit against a plain program that copies its strings.
    assert cut[1][5:7] == plain_dp([(r, x) for c, _, r, x in rows if c == 1])


def plain_dp(rows):
    """Cheapest cost and least audit, with whole strings as values."""
    step = {("", "u"): "u", ("", "s"): "s", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def inserts(now):
        for _ in range(2):
            for s, (cost, audit) in list(now.items()):
                to = "a" if s == "u" else "u"
                now[to] = min(now.get(to, (1e9, "")), (cost + 2, audit + "I"))
        return now

    now = inserts({"": (0, "")})
    for (role, _), kind in zip(rows, faults(rows)):
        new = {}

        def offer(s, way):
            new[s] = min(new.get(s, (1e9, "")), way)

        for s, (cost, audit) in now.items():
            offer(s, (cost + 3, audit + "D"))
            if kind in ("blank", "duplicate"):
                continue
            more = kind == "truncated"
            if (s, role[:1]) in step:
                offer(step[s, role[:1]], (cost + more, audit + "K"))
            offer("a" if s == "u" else "u", (cost + 2 + more, audit + "R"))
        now = inserts(new)
    return min(now[s] for s in ("", "a") if s in now)


def test_many_random_conversations_against_the_plain_program(spark):
    rows = drawn(9, 1500, 40)
    got = records(repair.repair_report(spark.createDataFrame(rows, SCHEMA)))
    by = {}
    for c, t, r, x in sorted(rows, key=lambda r: r[:2]):
        by.setdefault(c, []).append((" " if r is None else r, " " if x is None else x))
    assert {c: v[5:7] for c, v in got.items()} == {c: plain_dp(v) for c, v in by.items()}


def test_audits_compare_like_strings():
    draw = random.Random(3)
    for hashed in (ord, lambda label: 0):  # with the second every hash collides
        audits = repair.Audits(hashed)
        nodes = [0]
        for _ in range(400):
            nodes.append(audits.add(draw.choice(nodes[-30:]), draw.choice("DIK")))
        texts = {n: audits.text(n) for n in nodes}
        for _ in range(4000):
            a, b = draw.choice(nodes), draw.choice(nodes)
            assert audits.less(a, b) == (texts[a] < texts[b])
        for n in nodes:
            for d in (0, audits.depth[n] // 2, audits.depth[n]):
                assert texts[n].startswith(audits.text(audits.ancestor(n, d))) and len(audits.text(audits.ancestor(n, d))) == d


def test_audits_of_long_labels():
    draw = random.Random(4)
    audits = repair.Audits()
    nodes = [0]
    for _ in range(300):
        nodes.append(audits.add(draw.choice(nodes[-8:]), "".join(draw.choice("DK") for _ in range(draw.randrange(1, 4)))))
    for _ in range(4000):
        a, b = draw.choice(nodes), draw.choice(nodes)
        assert audits.less(a, b) == (audits.text(a) < audits.text(b))


def test_edges(spark):
    rows = [(None, None, "user", "a."), (None, 5, "assistant", "b."), (3, None, None, None), (3, None, None, None), (4, 2, "user", "hi"), (4, 2, "user", "hi")]
    long = [(6, 1, "user", "x" * 2_000_000 + "."), (6, 2, "assistant", "y. " * 100_000)]
    said = spark.createDataFrame(rows + long, SCHEMA).selectExpr("*", "'x' AS row", "'x' AS kind", "'x' AS audit", "'x' AS fault")
    got = records(repair.repair_report(said))
    empty = sha256(b"").hexdigest()
    assert got[None] == (0, 0, 0, 0, 0, 0, "KK", sha256(b"user:a.\nassistant:b.").hexdigest())
    assert got[3] == (0, 2, 0, 0, 1, 6, "DD", empty)
    assert got[4] == (0, 0, 1, 1, 1, 6, "DD", empty)
    assert got[6][:7] == (0, 0, 0, 0, 0, 0, "KK")
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_report(repair.damaged(none)).count() == 0 and repair.repaired_messages(none).count() == 0
    gone = said.selectExpr("conv_id", "turn", "role", "text", "conv_id = 4 AS kept")
    assert records(repair.repair_report(gone))[6] == (0, 0, 0, 0, 0, 0, "", empty)


def test_repaired_messages_are_legal(spark):
    rows = drawn(4, 60, 8)
    out = {}
    for r in sorted(repair.repaired_messages(spark.createDataFrame(rows, SCHEMA), stretch=2).collect(), key=lambda r: (r.conv_id, r.place)):
        assert r.place == len(out.setdefault(r.conv_id, []))
        out[r.conv_id].append((r.role, r.text))
    report = records(repair.repair_report(spark.createDataFrame(rows, SCHEMA)))
    assert out
    for c, turns in out.items():
        assert LEGAL.fullmatch("".join(r[:1] for r, _ in turns))
        assert sha256("\n".join(f"{r}:{x}" for r, x in turns).encode()).hexdigest() == report[c][-1]
