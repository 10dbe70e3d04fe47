"""Repairs of conversations against an exhaustive search, whole and in runs."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from tallymart.llm import conversations as conv

PATTERN = re.compile("(s?(ua)+)?")


def least_repair(rows, longest=9):
    """Cost, audit and text of the cheapest repair: every edit string in turn, by plain recursion.

    ``rows`` are (role, text, fault).
    """
    best = (10**9, "", "")
    stack = [(0, 0, "", "", [])]
    while stack:
        k, cost, audit, roles, out = stack.pop()
        if cost > best[0]:
            continue
        if k == len(rows) and PATTERN.fullmatch(roles):
            best = min(best, (cost, audit, "\n".join(out)))
        if len(roles) < longest:
            stack += [(k, cost + 2, audit + "I", roles + r[0], [*out, f"{r}:"]) for r in ("user", "assistant")]
        if k < len(rows):
            role, text, fault = rows[k]
            stack.append((k + 1, cost + 3, audit + "D", roles, out))
            if fault not in "bd":
                more = int(fault == "t")
                stack += [(k + 1, cost + 2 + more, audit + "R", roles + r[0], [*out, f"{r}:{text}"]) for r in ("user", "assistant")]
                stack.append((k + 1, cost + more, audit + "K", roles + (role[:1] or "?"), [*out, f"{role}:{text}"]))
    return best


def test_search_finds_the_least_audit():
    r = random.Random(9)
    for _ in range(250):
        n = r.randint(0, 5)
        rows = [(r.choice(["system", "user", "assistant", "user", "assistant", "tool"]), f"t{k}", r.choice("---tbd")) for k in range(n)]
        initials = "".join(x[0] if x[0] in "sua" else "x" for x, *_ in rows)
        cost, audit, _ = least_repair(rows, 7)
        assert conv.search(initials, "".join(x[2] for x in rows), conv.EMPTY, conv.ACCEPTED) == (cost, audit), rows


def plainly(initials, faults, entry, leaves):
    """One-sided search of all nodes, for long conversations."""
    labels = {(0, entry): (0, "")}
    for at in range(len(initials) + 1):
        for _ in range(4):  # insertions go round
            for state in range(4):
                if (at, state) in labels:
                    c, a = labels[at, state]
                    to = (at, conv.WANTED[state])
                    labels[to] = min(labels.get(to, (10**9, "")), (c + 2, a + "I"))
        if at < len(initials):
            for state in range(4):
                if (at, state) in labels:
                    c, a = labels[at, state]
                    for letter, more, to in conv._row_edges(initials[at], faults[at])[0][state]:
                        node = (at + 1, to)
                        labels[node] = min(labels.get(node, (10**9, "")), (c + more, a + letter))
    found = [labels[len(initials), s] for s in leaves if (len(initials), s) in labels]
    return min(found) if found else None


@pytest.mark.parametrize("size", [1, 3, 20, 1000])
def test_runs_put_together_equal_one_search(size):
    r = random.Random(size)
    for n in (0, 1, 5, 40, 200):
        initials = "".join(r.choice("suauauax") for _ in range(n))
        faults = "".join(r.choice("-----tbd") for _ in range(n))
        whole = plainly(initials, faults, conv.EMPTY, conv.ACCEPTED)
        assert conv.search(initials, faults, conv.EMPTY, conv.ACCEPTED) == whole
        tables, cuts = [], list(range(0, n, size))
        for a in cuts:
            part = initials[a : a + size], faults[a : a + size]
            leaves = [conv.ACCEPTED] if a + size >= n else [(t,) for t in range(4)]
            ways = [(s, t[-1], conv.search(*part, s, t)) for s in ([0] if a == 0 else range(4)) for t in leaves]
            assert all(w == plainly(*part, s, conv.ACCEPTED if a + size >= n else (t,)) for s, t, w in ways)
            tables.append([[s, t, *w] for s, t, w in ways if w])
        assert conv.through_runs(tables) == whole


def report_by_brute_force(rows, damaged=True):
    out, groups, ids = {}, collections.defaultdict(list), {r[0] for r in rows}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            groups[c] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for c in ids:
        own = sorted(groups[c], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        faults, seen = [], set()
        for _, role, text in own:
            filled = re.sub("[\x20\x09-\x0d]", "", text)
            faults.append("b" if not filled else "d" if (role, text) in seen else "-" if filled[-1] in ".!?" else "t")
            seen.add((role, text))
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        initials = "".join(x[1][:1] if x[1][:1] in ("s", "u", "a") else "x" for x in own)
        cost, audit = plainly(initials, "".join(faults), 0, conv.ACCEPTED)
        lines, state, k = [], 0, 0
        for letter in audit:
            if letter in "IR":
                state = conv.WANTED[state]
                lines.append(f"{conv.ROLES[state]}:{own[k][2] if letter == 'R' else ''}")
            elif letter == "K":
                state = conv.KEPT[state, initials[k]]
                lines.append(f"{own[k][1]}:{own[k][2]}")
            k += letter != "I"
        counts = (faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost)
        out[c] = (gaps, *counts, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


AWKWARD = [
    *((1, k, "user" if k % 2 else "assistant", f"Turn {k}.") for k in range(40)), *((1, 3, "user", "Turn 3.") for _ in range(2)),
    (2, None, None, None), (2, None, "system", "A null turn."), (2, 7, "tool", "\n\t "), (2, 5, "", "no stop"), (2, 900, "user", "é漢😀!"), (2, 6, "System", "x" * 50_000 + "."),
    (None, 0, "user", "No id."), (None, 1, "user", "No id either"), (None, None, "assistant", "."), (3, 0, "user", ""), (4, None, None, None), (5, 9, "assistant", "Alone!"),
    *((6, 1, "user", f"Same turn, text {k}.") for k in range(9)), *((k, 0, "user", "Hi.") for k in range(100, 160)),
]


@pytest.mark.parametrize("block", [3, conv.BLOCK])
@pytest.mark.parametrize("damaged", [True, False])
def test_report(spark, block, damaged):
    schema = "conv_id long, turn long, role string, text string, conv string, at int, audit string"
    rows = spark.createDataFrame([(*r, "x", 1, "y") for r in AWKWARD], schema).repartition(3)
    found = conv.repair_report(rows, damaged, block).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == report_by_brute_force(AWKWARD, damaged)
    assert len(found) == len({r[0] for r in AWKWARD})


def test_report_of_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    found = {r[0]: tuple(r)[1:] for r in conv.repair_report(rows).collect()}
    expected = report_by_brute_force([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    assert found == expected and len({x[-2] for x in expected.values()}) > 20
    assert conv.repair_report(rows.limit(0)).count() == 0


def test_repaired_rows_have_the_pattern(spark):
    given = conv.read(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    roles = collections.defaultdict(list)
    for r in conv.repaired_rows(conv.repair(conv.damage(given), given)).collect():
        roles[r.conv].append((r.place, r.role[0]))
    assert roles
    for some in roles.values():
        assert [p for p, _ in sorted(some)] == list(range(1, len(some) + 1))
        assert PATTERN.fullmatch("".join(x for _, x in sorted(some)))
