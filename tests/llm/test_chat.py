"""Op 9 against a plain reading of the rows, and trees."""

import hashlib
import random

from conftest import SF001
from pyspark.sql import functions as F

from pacewise.llm import chat, queries

CONTROL = ["<s>", "</s>", "<|", "|>", "[INST]", "[/INST]", "~", "~1", "~0", "<", "|", "[", "é", "😀", "\n", "ok", "</s>\n", "|>\n"]
NODES = "tree bigint, node bigint, parent bigint, role string, text string, score double"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark):
    by = {}
    for r in spark.read.parquet(f"{SF001}/conversations.parquet").collect():
        by.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    by[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = queries.op9_chat(spark, SF001).collect()
    assert len(got) == len(by)
    for r in got:
        turns = sorted(by[r["conv_id"]])
        said = "".join(t for _, role, t in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), sha("".join(f"{role}\n{t}\n" for _, role, t in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), sha(said))


def test_control_strings_come_back(spark):
    rnd, rows = random.Random(6), []
    make = lambda: "".join(rnd.choice(CONTROL) for _ in range(rnd.randint(0, 9)))
    for t in range(60):
        rows += [(t, k, k - 1 if k else None, rnd.choice(["user", "assistant", make()]), make(), 0.0) for k in range(5)]
    made = chat.format_paths(spark.createDataFrame(rows, NODES))
    read = made.select("tree", "formatted", chat.read_turns(F.col("formatted")).alias("t"),
                       chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for r in read:
        mine = [x for x in rows if x[0] == r["tree"]]
        assert [(x["role"], x["text"]) for x in r["t"]] == [(x[3], x[4]) for x in mine]
        assert r["loss"] == "".join(x[4] for x in mine if x[3] == "assistant")
        body = r["formatted"][len("<s>"):]
        assert "[INST]" not in body and "[/INST]" not in body and "<s>" not in body
        assert body.count("</s>") == body.count("<|") == body.count("|>") == 5


def test_trees_rank_their_branches(spark):
    rows = [(1, 0, None, "user", "q", 1.0), (1, 1, 0, "assistant", "a", 2.0), (1, 2, 0, "assistant", "b", 5.0), (1, 3, 1, "user", "c", 9.0),
            (1, 4, 1, "user", "d", None), (2, 7, 99, None, None, None),              # parent unknown: a root
            (3, 1, 2, "user", "x", 0.0), (3, 2, 1, "user", "y", 0.0), (3, 3, 2, "user", "z", 0.0),  # leads into a cycle
            (None, 1, None, "assistant", "n", 0.0)]
    rows += [(5, k, k - 1 if k else None, "assistant" if k % 2 else "user", f"t{k}", 0.0) for k in range(70)]
    nodes = spark.createDataFrame([(*r, "x") for r in rows], NODES + ", extra string")
    got = {(r["tree"], r["path_rank"]): r for r in chat.format_paths(nodes).collect()}
    text = lambda r: r["formatted"].replace("<|", "").replace("|>\n", ":").replace("</s>\n", " ")[3:]
    assert set(got) == {(1, 1), (1, 2), (1, 3), (2, 1), (None, 1), (5, 1)}
    assert [text(got[1, k]).split() for k in (1, 2, 3)] == [["user:q", "assistant:a", "user:c"], ["user:q", "assistant:b"],
                                                            ["user:q", "assistant:a", "user:d"]]
    assert [got[1, k]["path_score"] for k in (1, 2, 3)] == [12.0, 6.0, 3.0]
    assert text(got[2, 1]) == ": " and got[None, 1]["n_turns"] == 1
    assert text(got[5, 1]).split() == [f"{r[3]}:{r[4]}" for r in rows if r[0] == 5]
    assert {r["path_rank"] for r in chat.format_paths(nodes, best=1).collect()} == {1}
    assert chat.format_paths(nodes.limit(0)).collect() == []


def test_chain_of_turns_with_ties(spark):
    df = spark.createDataFrame([(1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, None, "user", None), (None, 1, None, "z")],
                               "conv_id int, turn int, role string, text string")
    got = chat.format_paths(chat.reply_chain(df)).select("tree", chat.read_turns(F.col("formatted")).alias("t")).collect()
    assert {r["tree"]: [x["text"] for x in r["t"]] for r in got} == {1: ["", "a", "a", "b"], None: ["z"]}
