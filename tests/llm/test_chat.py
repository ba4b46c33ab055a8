"""Role repair against every repair there is, and across partitions."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import chat
from millrace.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(roles):
    """Least cost over all ways to keep, merge, relabel and insert."""
    best = None
    for choice in itertools.product(chat.ROLES, ("plain", "merge", "insert"), repeat=len(roles)):
        state, cost = None, 0
        for role, new, how in zip(roles, choice[::2], choice[1::2]):
            cost += chat.RELABEL * (new != role)
            if how == "merge":
                if new != state:
                    break
                cost += chat.MERGE
                continue
            if how == "insert":
                other = {"user": "assistant", "assistant": "user"}.get(new)
                if other is None or (other == "assistant") != (state == "user"):
                    break
                state = other
                cost += chat.INSERT
            if {"system": state is not None, "user": state == "user", "assistant": state != "user"}[new]:
                break
            state = new
        else:
            cost += {None: 0, "system": 2 * chat.INSERT, "user": chat.INSERT, "assistant": 0}[state]
            best = cost if best is None else min(best, cost)
    return best


def test_cost_is_least():
    rng = random.Random(5)
    pool = ["system", "user", "assistant", "tool", None]
    cases = [list(c) for n in (0, 1, 2) for c in itertools.product(pool, repeat=n)]
    cases += [[rng.choice(pool) for _ in range(rng.choice((3, 4)))] for _ in range(25)]
    for roles in cases:
        assert chat.repair(roles)[1] == cheapest([r if r in chat.ROLES else None for r in roles]), roles


def parts(text):
    return [p.split("\n", 1) for p in text.split("<|im_start|>")[1:]]


def rendered(df):
    rows = df.orderBy("conv_id", "run", "position").collect()
    return {c: "".join(r["fragment"] for r in g) for c, g in itertools.groupby(rows, key=lambda r: r["conv_id"])}


def test_rendered_chats_are_legal_and_keep_texts(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice([*chat.ROLES, "x"]), f"text{c}-{t}") for c in range(30) for t in range(rng.randint(1, 9))]
    df = chat.format_chats(spark.createDataFrame(rows, SCHEMA))
    for conv, text in rendered(df).items():
        roles = [r for r, _ in parts(text)]
        body = roles[1:] if roles[0] == "system" else roles
        assert body == ["user", "assistant"] * (len(body) // 2) and body
        assert all(b.endswith("<|im_end|>\n") and b.count("<|im_end|>") == 1 for _, b in parts(text))
        kept = [x for _, b in parts(text) for x in b.removesuffix("<|im_end|>\n").split("\n") if x]
        assert kept == [r[3] for r in rows if r[0] == conv]


def test_a_chat_over_many_partitions_equals_one_repaired_whole(spark, monkeypatch):
    rng = random.Random(9)
    roles = [rng.choice([*chat.ROLES, "tool"]) for _ in range(400)]
    rows = [(7, t, r, f"t{t}") for t, r in enumerate(roles)] + [(c, 0, "user", "hi") for c in (1, 9)]
    monkeypatch.setattr(chat, "slots", lambda s: 13)
    df = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).cache()
    assert df.filter("conv_id = 7").select("run").distinct().count() > 5
    path, cost = chat.repair(roles)
    got = df.filter("conv_id = 7").orderBy("turn").collect()
    assert [(r["new_role"], r["action"], r["inserted"]) for r in got] == [(o[4], o[3], o[5]) for o in path]
    assert sum(r["cost"] for r in got) == cost
    whole = "".join(chat._render(o, i == 0, i == len(path) - 1, f"t{i}") for i, o in enumerate(path))
    assert rendered(df)[7] == whole
    df.unpersist()


def test_nulls_ties_repeats_and_empty_tables(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, None, None), (None, None, "ASSISTANT ", "b"), (1, None, "system", "s")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("fragment", F.lit("clash")).withColumn("conv", F.lit(1))
    out = chat.format_chats(df)
    assert out.count() == 4
    text = rendered(out)
    assert text[None] == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert text[1].startswith("<|im_start|>system\ns<|im_end|>\n")
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", ["op10_chat_format"])
def test_query_repairs_every_conversation_at_least_cost(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).groupBy("conv_id").agg(F.sum("cost").alias("cost")).collect()
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").distinct().collect()
    by = {}
    for r in sorted(turns, key=lambda r: (r["turn"], r["role"] or "", r["text"] or "")):
        by.setdefault(r["conv_id"], []).append(r["role"])
    assert {r["conv_id"]: r["cost"] for r in got} == {c: chat.repair(roles)[1] for c, roles in by.items()}
