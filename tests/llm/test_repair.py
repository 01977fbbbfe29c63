"""Conversation repair against a search over whole edit scripts."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from martloom.llm import repair
from martloom.llm.queries import op12_repair

SCHEMA = "conv_id long, turn long, role string, text string"


def first_faults(rows):
    """``rows`` are role and text in order; the first fault of each."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows):
    """Cost, audit and repaired rows by dynamic programming over (row, initials so far as a state), keeping whole scripts."""
    faults = first_faults(rows)
    accept, step = {"", "A"}, {("", "s"): "S", ("", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
    best = {"": (0, "", [])}

    def offer(table, state, script):
        if state not in table or script[:2] < table[state][:2]:
            table[state] = script

    def insert(table):
        for _ in range(4):
            for state, (cost, audit, made) in list(table.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in step:
                        offer(table, step[state, role[0]], (cost + 3, audit + "I", [*made, (role, "")]))

    insert(best)
    for (role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, made) in best.items():
            offer(after, state, (cost + 4, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            if (state, role[:1]) in step:
                offer(after, step[state, role[:1]], (cost + more, audit + "K", [*made, (role, text)]))
            for new in ("user", "assistant"):
                if (state, new[0]) in step:
                    offer(after, step[state, new[0]], (cost + 3 + more, audit + "R", [*made, (new, text)]))
        insert(after)
        best = after
    return min((best[s] for s in accept if s in best), key=lambda script: script[:2])


def expected(rows):
    """Result rows for ``(conv_id, turn, role, text)``."""
    damaged, out = {}, {}
    for conv, turn, role, text in rows:
        damaged.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        made = (turn, "user" if kind == 4 else role, text)
        damaged[conv] += {0: [], 3: [made, made]}.get(kind, [made])
    for conv, made in damaged.items():
        made.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        said = [(role, text) for _, role, text in made]
        faults = first_faults(said)
        turns = [t for t, _, _ in made if t is not None]
        cost, audit, fixed = cheapest(said)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") or not a[0] or not b[0] for a, b in itertools.pairwise(said)),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest(),
        )
    return out


def result(spark, path):
    return {r.conv_id: tuple(r)[1:] for r in op12_repair(spark, path).collect()}


def random_rows(seed=3):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", "", None], ["One.", "Two!", "three", " ", "", None, "Same? ", "é.\t", " "]
    rows = [(c, t if rng.random() < 0.95 else None, rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"say {c} {t}" + rng.choice([".", "!", ""]))
            for c in range(300) for t in range(rng.randrange(1, 12))]
    rows += [(-1, 5, "user", "Same.")] * 40 + [(-1, 6, "user", "Same.")] * 3 + [(None, 0, "user", "x."), (None, None, "assistant", "y.")]
    return rows + [(10**6, t, ["user", "assistant", "system"][t % 7 % 3], f"Long {t % 2500}.") for t in range(3000)] + [(7777, 1, "user", "word " * 50_000 + ".")]


@pytest.mark.parametrize(("chunk", "block"), [(1024, 1 << 14), (3, 5)])
def test_equals_search(spark, tmp_path, monkeypatch, chunk, block):
    monkeypatch.setattr(repair, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    rows = random_rows()
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS chunk", "2 AS `a.b`").repartition(6).write.parquet(f"{tmp_path}/conversations.parquet")
    got, want = result(spark, str(tmp_path)), expected(rows)
    assert got.keys() == want.keys()
    assert {c: (got[c], want[c]) for c in want if got[c] != want[c]} == {}


def test_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(spark, sf_dir) == expected(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(spark, str(tmp_path)) == {}


def test_ranking_takes_the_least_of_all_cheapest_scripts():
    """All edit scripts of short conversations, tried one by one."""
    for kinds in itertools.chain.from_iterable(itertools.product(range(9), repeat=n) for n in (1, 2)):
        found = repair.repair_codes([np.array(kinds)])[0]
        assert (found[0], found[1].decode()) == min(scripts(kinds))


def scripts(kinds, at=0, initials="", cost=0, audit=""):
    if re.fullmatch("(s?(ua)+)?", initials) and at == len(kinds):
        yield cost, audit
    if not re.match("^s?(ua)*u?$", initials) or audit.count("I") > len(kinds) + 2:
        return
    if at < len(kinds):
        initial, fault = "sua"[kinds[at] // 3], kinds[at] % 3
        yield from scripts(kinds, at + 1, initials, cost + 4, audit + "D")
        if fault != 2:
            yield from scripts(kinds, at + 1, initials + initial, cost + 3 * fault, audit + "K")
            for role in "ua":
                yield from scripts(kinds, at + 1, initials + role, cost + 3 + 3 * fault, audit + "R")
    for role in "ua":
        yield from scripts(kinds, at, initials + role, cost + 3, audit + "I")
