"""Structure repair and the prefix trie of conversations against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

from smelter.llm import conversation_repair as cr
from smelter.llm import conversation_trie as ct
from tests.oracle import connect, differences

SMALL = "/root/testdata/sf0.001"
KIND = "conv_id long, turn long, role string, text string"
ODD = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (1, 2, "", "x"), (2, 5, "assistant", "Hi. " * 30000),
       (None, 1, "user", "lost"), (None, None, "user", "lost"), (20, 0, "user", "a b\tc."), (20, 1, "assistant", "d!"), (21, 0, "user", "a b\tc."),
       (21, 1, "assistant", "d!"), (-3, 9, "system", ""), (2**63 - 1, 2**63 - 1, "user", "x."), (2**63 - 1, -2**63, "user", "y.")]


# ---- repair -------------------------------------------------------------------------------------------------------

def all_paths(turns):
    """Every (cost, audit, roles) with at most two insertions before each turn and at the end."""
    fills = [("", "")] + [("I" * n, "".join(p)) for n in (1, 2) for p in itertools.product("ua", repeat=n)]
    steps = []
    for letter, state in turns:
        extra = 3 * (state == cr.CUT)
        kept = [] if state == cr.GONE else [(extra, "K", letter), (3 + extra, "R", "u"), (3 + extra, "R", "a")]
        steps.append([(4, "D", "")] + kept)
    for picked in itertools.product(*steps):
        for filled in itertools.product(fills, repeat=len(turns) + 1):
            cost = sum(p[0] for p in picked) + 3 * sum(len(f[0]) for f in filled)
            both = list(itertools.chain(*zip(filled, [p[1:] for p in picked] + [("", "")], strict=True)))
            yield cost, "".join(b[0] for b in both), "".join(b[1] for b in both)


def by_length(turns):
    """The least (cost, audit), from the start, with the least audit of each length kept."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    now = {("", 0): (0, "")}

    def offer(held, key, value):
        if key not in held or value < held[key]:
            held[key] = value

    def fill(held):
        for _ in range(2):
            for (state, size), (cost, audit) in list(held.items()):
                for letter in "ua":
                    if (to := step.get((state, letter))) is not None:
                        offer(held, (to, size + 1), (cost + 3, audit + "I"))
        return held

    fill(now)
    for letter, state in turns:
        after = {}
        for (at, size), (cost, audit) in now.items():
            offer(after, (at, size + 1), (cost + 4, audit + "D"))
            if state != cr.GONE:
                extra = 3 * (state == cr.CUT)
                if (to := step.get((at, letter))) is not None:
                    offer(after, (to, size + 1), (cost + extra, audit + "K"))
                for other in "ua":
                    if (to := step.get((at, other))) is not None:
                        offer(after, (to, size + 1), (cost + 3 + extra, audit + "R"))
        now = fill(after)
    return min(v for (at, _), v in now.items() if at in ("", "a"))


def solved(turns):
    cost, path = cr.edits("".join(x for x, _ in turns).encode(), bytes(s for _, s in turns))
    return cost, "".join(cr.LETTERS[e] for e in path)


def test_edits_are_the_least_of_all():
    right = re.compile("(s?(ua)+)?")
    for n in (0, 1, 2):
        for turns in itertools.product(itertools.product("sua-", (cr.FINE, cr.CUT, cr.GONE)), repeat=n):
            want = min((c, a) for c, a, roles in all_paths(turns) if right.fullmatch(roles))
            assert solved(turns) == want == by_length(turns), turns


def test_edits_of_longer_conversations_and_in_blocks(monkeypatch):
    pick = random.Random(5)
    talks = [[(pick.choice("suuuaaa-"), pick.choice((cr.FINE, cr.FINE, cr.CUT, cr.GONE))) for _ in range(pick.randint(3, 25))] for _ in range(300)]
    plain = [solved(t) for t in talks]
    assert plain == [by_length(t) for t in talks]
    monkeypatch.setattr(cr, "BLOCK", 3)
    assert plain == [solved(t) for t in talks]
    assert solved([("u", cr.FINE), ("a", cr.FINE)] * 50_000) == (0, "K" * 100_000)


def repaired(rows):
    """What the query returns, written out plainly."""
    blank = re.compile(r"[^\x20\x09-\x0D]")
    text_of = lambda v: " " if v is None else str(v)
    talks = {}
    for conv, turn, role, text in rows:
        kept = talks.setdefault(conv, [])
        role, text = text_of(role), text_of(text)
        k = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        kept += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = {}
    for conv, kept in talks.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, turns = set(), [0] * 4, []
        for _, role, text in kept:
            found = blank.findall(text)
            fault = 1 if not found else 2 if (role, text) in seen else 3 if found[-1] not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            turns.append((role[:1] if role[:1] in ("s", "u", "a") else "-", (cr.FINE, cr.GONE, cr.GONE, cr.CUT)[fault]))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(kept))
        cost, audit = by_length(turns)
        have, left, fixed = "", list(kept), []
        for letter in audit:
            role = text = ""
            if letter != "I":
                _, role, text = left.pop(0)
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if have.endswith("u") else "user"
            have += role[0]
            fixed.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", have) and not left
        nums = {t for t, _, _ in kept if t is not None}
        gaps = min(max(nums) - min(nums) + 1 - len(nums), 2**63 - 1) if nums else 0
        out[conv] = (gaps, *faults[1:], illegal, cost, audit, hashlib.sha256("\n".join(fixed).encode()).hexdigest())
    return out


def test_repair_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    pick = random.Random(3)
    rows += [(1000 + pick.randrange(90), pick.choice([None, *range(9)]), pick.choice(["user", "assistant", "system", "tool", None, ""]),
              pick.choice(["One.", "Two", "", None, " \t", "Three! ", "f? "])) for _ in range(900)]
    for data in (rows, ODD):
        got = {r.conv_id: tuple(r)[1:] for r in cr.damage_and_repair(spark.createDataFrame(data, KIND).repartition(5)).collect()}
        assert got == repaired(data)


def test_repair_keeps_lost_conversations_and_odd_tables(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    data = spark.createDataFrame([(gone, 0, "user", "x.", 1)], KIND + ", fault int")
    assert [tuple(r) for r in cr.damage_and_repair(data).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert cr.damage_and_repair(data.where("false")).collect() == []
    plain = cr.repair(spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], KIND)).first()
    assert (plain.cost, plain.audit) == (0, "KK")


# ---- trie ---------------------------------------------------------------------------------------------------------

def nodes_of(rows):
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [t[2:] for t in sorted(ts)] for c, ts in talks.items()}
    built = {}
    for c, turns in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(talks.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    value = {p: (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p, m in members.items()}
    kids = {p: [q for q in members if len(q) == len(p) + 1 and q[:len(p)] == p] for p in members}
    out = []
    for p, m in members.items():
        under = [q for q in members if q[:len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in m if built[c] == p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), sum(not kids[q] for q in under),
                    sum(value[q] for q in under), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_trie_against_brute_force(spark):
    pick = random.Random(8)
    rows = [(pick.randrange(-45, 90), pick.choice([None, 0, 1, 2]), pick.choice(["user", None, ""]), pick.choice(["a b", "", None, "c"])) for _ in range(260)]
    rows += [(400 + i, j, "user", f"same {j}") for i in range(60) for j in range(5)]
    for data in (rows, ODD):
        got = sorted((tuple(r) for r in ct.trie(spark.createDataFrame(data, KIND).repartition(4)).collect()), key=repr)
        assert got == nodes_of(data)


def test_trie_odd_tables_and_sql(spark):
    table = spark.createDataFrame([(7, 0, "user", "x", 1, b"")], KIND + ", depth int, prefix binary")
    assert len(ct.trie(table).collect()) == 2 - min(1, zlib.crc32(b"7") % 4)
    assert ct.trie(table.where("false")).collect() == []
    assert not differences(ct.trie(spark.read.parquet(f"{SMALL}/conversations.parquet")), connect(SMALL), ct.TRIE_SQL)


def test_crowded_ends_are_digested_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ct, "END_BITS", 3)
    rows = [(c, 0, "user", "x") for c in range(0, 20000, 20)]  # a family's first has its own turns whatever it shares
    root, node = sorted(ct.trie(spark.createDataFrame(rows, KIND)).collect(), key=lambda r: r.depth)
    assert (root.n_convs, node.n_convs, node.n_leaves, node.saved_tokens) == (1000, 1000, 1, 999)
    assert node.ends_sha256 == hashlib.sha256(",".join(str(r[0]) for r in rows).encode()).hexdigest()
