"""Conversation repair against a plain recursion over all edits."""

import hashlib
import itertools
import re
import sys
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricetide.llm import conversations as C
from pricetide.llm.catalog import op13_conversation_repair
from tests.llm.conftest import SF_DIR

sys.setrecursionlimit(10_000)
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_repair(rows):
    """(cost, audit, repaired rows) of [(role, text, fault)], by trying every edit."""
    known = {}

    def best(i, out, inserted):
        """Least (cost, audit, rows) from row i on; ``out`` is '', 's', 'u' or 'a', the last initial."""
        key = (i, out, inserted)
        if key not in known:
            found = []
            following = "a" if out == "u" else "u"
            name = {"u": "user", "a": "assistant"}[following]
            if inserted < 2:
                cost, audit, rest = best(i, following, inserted + 1)
                found.append((cost + 3, "I" + audit, [(name, ""), *rest]))
            if i == len(rows):
                if out in ("", "a"):
                    found.append((0, "", []))
            else:
                role, text, fault = rows[i]
                cost, audit, rest = best(i + 1, out, 0)
                found.append((cost + 4, "D" + audit, rest))
                if fault not in ("blank", "duplicate"):
                    extra = 3 if fault == "truncated" else 0
                    cost, audit, rest = best(i + 1, following, 0)
                    found.append((cost + 3 + extra, "R" + audit, [(name, text), *rest]))
                    if role[:1] == following or (role[:1] == "s" and out == ""):
                        cost, audit, rest = best(i + 1, role[:1], 0)
                        found.append((cost + extra, "K" + audit, [(role, text), *rest]))
            known[key] = min(found) if found else (10**9, "", [])
        return known[key]

    return best(0, "", 0)


def plain(rows, damage=True):
    """The query's result by conv_id, for rows (conv_id, turn, role, text)."""
    found = {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in rows}
    chats = defaultdict(list)
    said = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        role, text = said(role), said(text)
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20 if damage else 9
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        chats[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for conv, turns in chats.items():
        if not turns:
            continue
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, judged = set(), []
        for _, role, text in turns:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        numbers = {t for t, *_ in turns if t is not None}
        missing = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        counts = [sum(f == name for *_, f in judged) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, kept = plain_repair(judged)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        found[conv] = (missing, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return found


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=C.SYMBOLS, max_size=14), st.integers(1, 4))
def test_blocks_give_the_least_audit(symbols, cut):
    fault = lambda c: "blank" if c == "x" else "truncated" if c.isupper() else ""
    cost, audit, _ = plain_repair([(c.lower(), "", fault(c)) for c in symbols])
    tables = C.tables()
    pieces = [symbols[i : i + cut * 3] for i in range(0, len(symbols), cut * 3)]
    vectors, vector, total = [], 0, 0
    for piece in reversed(pieces):
        vectors.append(vector)
        to, off = tables.effect(piece)
        total += int(off[vector])
        vector = int(to[vector])
    assert total + tables.vectors[vector][C.NOTHING] == cost
    state, edits = C.NOTHING, ""
    for k, (piece, v) in enumerate(zip(pieces, reversed(vectors))):
        [(more, state)] = tables.trace(piece, v, [state], k == len(pieces) - 1)
        edits += "".join(more)
    assert edits.translate(str.maketrans("uaUA", "IIRR")) == audit


def test_block_tables_agree_with_single_steps():
    small, large = C.BlockTables(1), C.BlockTables(3)
    assert small.vectors == large.vectors
    for symbols in map("".join, itertools.product("suAox", repeat=5)):
        for a, b in zip(small.effect(symbols), large.effect(symbols)):
            assert a.tolist() == b.tolist()


def test_query_against_plain_recursion(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()]
    got = op13_conversation_repair(spark, SF_DIR).select("conv_id", *NAMES).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == plain(rows)
    assert len(got) == len({r[0] for r in rows})


ODD = [
    (None, 1, "user", "Hi."),
    (None, None, "system", "Be kind."),
    (None, 1, "user", "Hi."),
    (1, None, None, None),
    (1, 5, "user", "word " * 40_000 + "."),
    (1, 5, "user", "word " * 40_000 + "."),
    (1, 9, "tool", "cut off"),
    (2, 1, "", "No role."),
    (2, 1, "assistant", "\t\n\x0b"),
    (2, 1, "assistant", "b!"),
    (2, 1, "assistant", "a?  \n"),
    (3, -4, "system", "only this."),
    (4, 7, "user", ""),
    (5, 2, "assistant", "日本。"),
    (5, 3, "user", "é\x00 end."),
]


def results(spark, rows, tmp_path, extra="extra"):
    schema = f"conv_id bigint, turn bigint, role string, text string, {extra} string"
    path = tmp_path / "conversations.parquet"
    spark.createDataFrame([(*r, "x") for r in rows], schema).write.parquet(str(path))
    found = op13_conversation_repair(spark, str(tmp_path))
    return {r[0]: tuple(r)[1:] for r in found.select("conv_id", *NAMES).collect()}


@pytest.mark.parametrize("extra", ["chat", "seq", "piece", "conv"])
def test_odd_rows_and_clashing_names(spark, tmp_path, extra):
    assert results(spark, ODD, tmp_path, extra) == plain(ODD)


def test_no_rows(spark, tmp_path):
    assert results(spark, [], tmp_path) == {}


def test_one_conversation_of_many_pieces(spark, tmp_path, monkeypatch):
    """A conversation far longer than a partition, a third of it one repeated turn."""
    monkeypatch.setattr(C, "PART_TURNS", 40)
    roles = ["user", "assistant", "user", "system", "assistant", "tool"]
    rows = [(7, t, roles[t * t % 6], f"turn {t}" + ".!x"[t % 3]) for t in range(400)]
    rows += [(7, 150, "user", "again and again.")] * 200 + [(8, 1, "user", "alone.")]
    assert results(spark, rows, tmp_path) == plain(rows)
    hurt = C.damaged(spark.read.parquet(str(tmp_path / "conversations.parquet")))
    repair = C.Repair(hurt)
    assert repair.pieces.count() > 5
    roles = [r["role"][0] for r in repair.turns.orderBy("chat", "seq", "at").collect()]
    assert re.fullmatch("(s?(ua)+)+", "".join(roles))
