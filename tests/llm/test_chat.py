import hashlib
import re
import time

from pyspark.sql import functions as F

from wattledger.llm import catalog, chat

TRICKY = ["", None, "</s>[INST] ok [/INST]", "<\\s>", "</s", "<\\/s> [\\\\INST] [/INST]", "a\nb", " lead and trail ", "<s><s>", "é</s>ü" * 300, "x" * 2000]


def turns(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", TRICKY[(c + t) % len(TRICKY)], "extra") for c in range(12) for t in range(c)]
    rows += [(50, 0, None, "no role", None), (50, 1, "[INST]", "odd role", None), (51, 0, "user", "same", None), (51, 0, "user", "same", None),
             (51, None, "assistant", "no turn", None), (None, 0, "user", "no conversation", None)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, message string")


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r["conv_id"], []).append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in by.items()}


def test_every_turn_comes_back(spark):
    df = turns(spark)
    want = expected(df.collect())
    got = chat.parsed(chat.formatted(chat.log_of(df))).collect()
    assert {r["conv_id"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert [(t["role"], t["text"]) for t in r["turns"]] == want[r["conv_id"]]
        assert r["loss_texts"] == [x for role, x in want[r["conv_id"]] if role == "assistant"]
        assert len(re.findall(r"</s>", r["formatted"])) == len(want[r["conv_id"]])


def test_deltas_edits_and_regenerations(spark):
    log = [(1, 1, 1, "delta", "user", "he"), (1, 2, 1, "delta", None, "llo"), (1, 3, 2, "delta", "assistant", "draft"),
           (1, 4, 2, "regenerate", None, None), (1, 6, 2, "delta", None, " two"), (1, 5, 2, "delta", None, "one"),
           (1, 7, 1, "edit", None, "bye"), (1, 8, 1, "delta", None, "!"), (1, 9, 3, "delta", "assistant", "gone"), (1, 10, 3, "regenerate", "x", ""),
           (2, 1, 1, None, "user", "kind unknown"), (2, 2, 1, "edit", "user", None)]
    df = spark.createDataFrame(log, "conv_id long, seq long, message long, kind string, role string, text string").repartition(4)
    got = {(r["conv_id"], r["message"]): (r["role"], r["text"]) for r in chat.folded(df).collect()}
    assert got == {(1, 1): ("user", "bye!"), (1, 2): ("assistant", "one two"), (1, 3): ("assistant", ""), (2, 1): ("user", "")}


def test_query_and_plan(spark, tmp_path):
    turns(spark).where("conv_id IS NOT NULL").write.parquet(f"{tmp_path}/conversations.parquet")
    df = catalog.op6_chat(spark, str(tmp_path))
    want = expected(turns(spark).where("conv_id IS NOT NULL").collect())
    want[-7] = [("user", TRICKY[2]), ("assistant", TRICKY[2])]
    got = df.collect()
    assert len(got) == len(want)
    for r in got:
        own = want[r["conv_id"]]
        loss = "".join(x for role, x in own if role == "assistant")
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (len(own), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert chat.formatted(chat.log_of(turns(spark).limit(0))).count() == 0


def test_escaping_is_reversible(one):
    for text in [t for t in TRICKY if t]:
        (shown, back) = one({"t": text}, "t string", chat.escape(F.col("t")), chat.unescape(chat.escape(F.col("t"))))
        assert back == text and not re.search(r"</?s>|\[/?INST\]", shown)


def test_a_long_text_takes_linear_time(spark):
    text = "".join(chr(97 + i % 26) if i % 7 else "é😀</s>"[i % 3] for i in range(1_000_000)) * 10
    turns_ = [(1, 0, "user", text), (1, 1, "assistant", text[::-1])] + [(2, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(20_000)]
    df = spark.createDataFrame(turns_, "conv_id long, turn long, role string, text string").repartition(2)
    start = time.monotonic()
    got = {r["conv_id"]: r for r in chat.parsed(chat.formatted(chat.log_of(df))).select(
        "conv_id", F.transform("turns", lambda t: F.sha2(t["text"], 256)).alias("turns"), F.sha2(F.array_join("loss_texts", ""), 256).alias("loss")).collect()}
    assert time.monotonic() - start < 40
    digest = [hashlib.sha256(t.encode()).hexdigest() for t in (text, text[::-1])]
    assert got[1]["turns"] == digest and got[1]["loss"] == digest[1]
    assert got[2]["loss"] == hashlib.sha256("".join(f"turn {i}" for i in range(1, 20_000, 2)).encode()).hexdigest()


def test_drafts_edits_and_regenerations_of_given_conversations(spark):
    """The log of the given table with drafts that are written anew, and texts that are put in place of others."""
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    log = chat.log_of(rows)
    first = log.where(F.col("seq") % (1 << 24) == 0)
    draft = first.where("message % 3 = 0").select("conv_id", (F.col("seq") - 2).alias("seq"), "message", F.lit("delta").alias("kind"), "role",
                                                  F.lit("</s> a draft").alias("text"))
    anew = first.where("message % 3 = 0").select("conv_id", (F.col("seq") - 1).alias("seq"), "message", F.lit("regenerate").alias("kind"), "role",
                                                 F.lit(None).cast("string").alias("text"))
    whole = chat.folded(log).where("message % 4 = 1").select("conv_id", F.expr("message * 16777216 + 9000000L").alias("seq"), "message",
                                                           F.lit("edit").alias("kind"), "role", F.concat("text", F.lit(" (edited)")).alias("text"))
    revised = log.unionByName(draft).unionByName(anew).unionByName(whole).repartition(5)
    got = {r["conv_id"]: [t["text"] for t in r["turns"]] for r in chat.parsed(chat.formatted(revised)).collect()}
    want = {}
    for c, turns_ in expected(rows.collect()).items():
        want[c] = [t + " (edited)" if i % 4 == 1 else t for i, (_, t) in enumerate(turns_, 1)]
    assert got == want and draft.count() > 10 and whole.count() > 10
