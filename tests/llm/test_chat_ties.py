"""Turns of one number are ordered alike by the operator and its SQL."""

from __future__ import annotations

import random

import duckdb

from lacuna.llm import chat
from lacuna.llm.oracles import ORACLES


def test_ties_as_the_sql_orders_them(spark):
    rng = random.Random(4)
    rows = [(1, 0, "user", "b"), (1, 0, "bot", "c"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "bot", "c"), (2, 0, "user", "b")]
    rows += [(2, 1, "bot", "later"), (3, None, None, "x"), (3, None, "bot", None), (3, None, "bot", "é"), (3, None, "bot", "z")]
    for conv in range(10, 60):
        for _ in range(rng.randint(1, 6)):
            rows.append((conv, rng.choice([None, 0, 0, 1]), rng.choice(["user", "bot", None]), rng.choice(["a", "b", "é", "Z", None])))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = sorted((r.conv_id, r.n_turns, r.segment, r.text) for r in chat.chat_format(frame).collect())
    assert [g for g in got if g[0] == 1] == []  # the second conversation goes on where it ends
    assert got[0][3].startswith("<|bot|>\nc\n<|end|>\n<|user|>\na\n<|end|>\n<|user|>\nb\n")
    database = duckdb.connect()
    values = ", ".join(["(?, ?, ?, ?)"] * len(rows))
    database.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    database.execute(f"INSERT INTO conversations VALUES {values}", [x for row in rows for x in row])
    want = database.execute(ORACLES["op5_chat_format"].replace("ORDER BY turn, role", "ORDER BY turn NULLS FIRST, role"))
    names = [c[0] for c in want.description]
    want = sorted(tuple(row[names.index(c)] for c in ("conv_id", "n_turns", "segment", "text")) for row in want.fetchall())
    assert got == want
