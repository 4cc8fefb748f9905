"""Conversation repair against exhaustive search."""

import hashlib
import itertools
import re

import numpy as np
import pytest

from phenocast.llm import repair as R
from phenocast.llm.glr import FORCED, RepairParser

LEGAL = re.compile("(s?(ua)+)?")


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        end = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        out.append("b" if not end else "d" if (role, text) in seen else "" if end[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def _brute(rows):
    """All edits of short conversations, insertions of up to two turns anywhere."""
    faults, best = _faults(rows), None
    ins = [()] + [p for n in (1, 2) for p in itertools.product("ua", repeat=n)]
    names = {"u": "user", "a": "assistant"}

    def walk(k, cost, audit, out):
        nonlocal best
        if best and cost > best[0]:
            return
        for extra in ins:
            more = [(names[c], "") for c in extra]
            c, a, o = cost + 3 * len(extra), audit + "I" * len(extra), out + more
            if k == len(rows):
                if LEGAL.fullmatch("".join(r[:1] or "-" for r, _ in o)):
                    best = min(best, (c, a, o)) if best else (c, a, o)
                continue
            role, text = rows[k]
            walk(k + 1, c + 4, a + "D", o)
            if faults[k] in ("", "t"):
                late = 3 * (faults[k] == "t")
                walk(k + 1, c + late, a + "K", o + [(role, text)])
                for name in names.values():
                    walk(k + 1, c + 3 + late, a + "R", o + [(name, text)])

    walk(0, 0, "", [])
    return best


def _report(rows):
    """Counts, cost, audit and hash of (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, *_ in rows if t is not None]
    faults, initials = _faults([r[1:] for r in rows]), [r[1][:1] for r in rows]
    cost, audit, out = _solve([r[1:] for r in rows], faults)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest())


def _solve(rows, faults):
    """A plain table over the four places of the grammar, with whole audits and texts."""
    to = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(tops):
        tops, todo = dict(tops), list(tops.items())
        while todo:
            st, (c, a, o) = todo.pop()
            for t in "ua":
                if (st, t) in to:
                    new = (c + 3, a + "I", o + [(names[t], "")])
                    if to[st, t] not in tops or new < tops[to[st, t]]:
                        tops[to[st, t]] = new
                        todo.append((to[st, t], new))
        return tops

    tops = {"0": (0, "", [])}
    for (role, text), fault in zip(rows, faults):
        new = {st: (c + 4, a + "D", o) for st, (c, a, o) in tops.items()}
        new = [*new.items()]
        if fault in ("", "t"):
            late = 3 * (fault == "t")
            for st, (c, a, o) in inserted(tops).items():
                if (st, role[:1]) in to:
                    new.append((to[st, role[:1]], (c + late, a + "K", o + [(role, text)])))
                new += [(to[st, t], (c + 3 + late, a + "R", o + [(names[t], text)])) for t in "ua" if (st, t) in to]
        tops = {}
        for st, x in new:
            tops[st] = min(tops.get(st, x), x)
    return min(x for st, x in inserted(tops).items() if st in "0a")


ROLES = ["system", "user", "assistant", "tool", ""]
TEXTS = ["Fine.", "Cut off", "", " \n", "Why?", "Yes!"]


def test_parser_equals_all_edits():
    rng, parser = np.random.default_rng(12), RepairParser()
    assert len(parser.starts) == 4
    for _ in range(250):
        rows = [(ROLES[a], TEXTS[b]) for a, b in zip(rng.choice(5, 4, p=[.2, .3, .3, .1, .1]), rng.integers(0, 6, 4))][:rng.integers(0, 5)]
        cost, audit, out = _brute(rows)
        faults = _faults(rows)
        assert (cost, audit, out) == _solve(rows, faults)
        got = parser.run([(FORCED, 1) if f in ("b", "d") else ((r[:1], f == "t"), 1) for (r, _), f in zip(rows, faults)])
        extra, k, end = parser.best([(x.state, c) for x, c in got.tops])
        text = parser.audit(got, k) + "I" * end
        assert (got.cost + extra, text) == (cost, audit) and parser.apply(text, [(r, x, 1) for r, x in rows]) == out


def _conversations(rng, n, most):
    rows = []
    for c in range(n):
        for t in range(rng.integers(1, most)):
            rows.append((None if c == 3 else c, None if rng.random() < 0.03 else int(t + rng.integers(0, 2)), ROLES[rng.choice(5, p=[.1, .4, .4, .05, .05])],
                         None if rng.random() < 0.03 else TEXTS[rng.integers(0, 6)] + (f"{t}." if rng.random() < 0.7 else ""), c))
    return rows


def _want(rows):
    groups = {}
    for c, t, r, x, *_ in rows:
        groups.setdefault(c, []).append((t, r, x))
    return {c: _report(v) for c, v in groups.items()}


def _got(df):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) for r in df.collect()}


@pytest.mark.parametrize("piece", [3, 4096])
def test_repair_equals_the_plain_table(spark, monkeypatch, piece):
    monkeypatch.setattr(R, "PIECE_ROWS", piece)
    rng = np.random.default_rng(piece)
    rows = _conversations(rng, 40, 30) + [(99, None, None, None, 0)] * 5 + [(98, 2, "user", "Same.", 0)] * 50 + [(97, 0, "user", "Long. " * 100_000, 0)]
    rows += [(96, t, ("user", "assistant")[rng.integers(0, 2)], "Again." if t % 3 else f"New {t}", 0) for t in range(700)]   # one long conversation
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int").repartition(5)  # copies: a clashing name
    assert _got(R.repair(df)) == _want(rows)
    turns = {}
    for r in sorted(R.repaired_turns(df).collect(), key=lambda r: (r["piece"], r["place"])):
        turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(turns.get(c, [])).encode()).hexdigest() for c in _want(rows)} == {c: v[-1] for c, v in _want(rows).items()}
    assert R.repair(df.limit(0)).collect() == [] and R.repaired_turns(df.limit(0)).collect() == []


def test_damage_and_the_query_on_odd_tables(spark, scratch):
    import zlib

    rows = _conversations(np.random.default_rng(2), 30, 9) + [(200 + k, 0, "user", "Only one.", 0) for k in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit int")
    df.write.parquet(f"{scratch}/conversations.parquet")
    hurt = []
    for c, t, r, x, _ in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if k:
            hurt += [(c, t, "user" if k == 4 else r, "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x)] * (2 if k == 3 else 1)
    got = [tuple(r) for r in R.damage(df).collect()]
    assert sorted(got, key=str) == sorted(hurt, key=str)
    want, empty = _want(hurt), (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = _got(R.op12_conversation_repair(spark, scratch))
    assert got == {c: want.get(c, empty) for c in {r[0] for r in rows}} and empty in got.values()
