"""Chat formatting for preference data: one prompt and a masked chosen and rejected completion for each pair.

Turns are (conv_id, turn, role, text). The longest common prefix of the chosen and the rejected turns (equal roles and texts)
is rendered once as the prompt; what is left of either side is its completion. A completion's mask is given as the ranges
of characters that train the model: the texts and end marks of its assistant turns.

Defined results: turns go by (turn, role, text), nulls first, so ties and repeated rows have a fixed order and repeated turns
stay. A null role is ``unknown``, a null text is empty. A pair with one side alone has an empty prompt and an empty other
completion; equal sides give a prompt and two empty completions. A turn without a conversation is the chosen side of a pair of its
own, with a null id. Marks of the template inside roles and texts can't pass for turns: ``<|`` becomes ``< |``. A conversation's
own turns are the only rows that are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The template.
OPEN, BREAK, CLOSE = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(F.lit(OPEN), x["role"], F.lit(BREAK), x["text"], F.lit(CLOSE))), "")


def _ranges(turns: Column) -> Column:
    """``start-end`` of each trained range in the rendered turns, comma-joined."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("said"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + F.lit(len(OPEN) + len(BREAK)) + F.length(x["role"])
        end = begin + F.length(x["text"]) + F.lit(len(CLOSE))
        trained = F.array(F.concat_ws("-", begin.cast("string"), end.cast("string")))
        return F.struct(end.alias("at"), F.when(x["role"] == TRAINED_ROLE, F.concat(s["said"], trained)).otherwise(s["said"]).alias("said"))

    return F.array_join(F.aggregate(turns, start, step, lambda s: s["said"]), ",")


def format_preferences(turns: DataFrame, pair: Column, rejected: Column) -> DataFrame:
    """One row per pair: pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask.

    ``pair`` names the pair of a turn, ``rejected`` tells whether its conversation is the rejected side."""
    safe = lambda c, default: F.replace(F.coalesce(c, F.lit(default)), F.lit(OPEN), F.lit("< |"))
    clean = turns.select(
        pair.alias("pair_id"), F.coalesce(rejected, F.lit(False)).alias("_r"),
        F.struct(F.col("turn"), safe("role", "unknown").alias("role"), safe("text", "").alias("text")).alias("x"),
    )
    alone = clean.filter("pair_id is null").select("pair_id", F.array("x").alias("a"), F.slice(F.array("x"), 1, 0).alias("b"))
    sides = clean.filter("pair_id is not null").groupBy("pair_id").agg(F.array_sort(F.collect_list(F.when(~F.col("_r"), F.col("x")))).alias("a"), F.array_sort(F.collect_list(F.when(F.col("_r"), F.col("x")))).alias("b")).unionByName(alone)
    most = F.least(F.size("a"), F.size("b"))
    same = F.zip_with(F.slice("a", 1, most), F.slice("b", 1, most), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    first = F.array_position(same, F.lit(False))
    n = F.when(first > 0, first - 1).otherwise(most).cast("int")
    cut = sides.withColumn("n", n)
    rest = lambda c: F.slice(c, F.col("n") + 1, F.size(c))
    return cut.select(
        "pair_id", F.col("n").cast("long").alias("n_common"), _rendered(F.slice("a", F.lit(1), F.col("n"))).alias("prompt"),
        _rendered(rest("a")).alias("chosen"), _rendered(rest("b")).alias("rejected"), _ranges(rest("a")).alias("chosen_mask"), _ranges(rest("b")).alias("rejected_mask"),
    )


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 are the chosen and the rejected side of pair k."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return format_preferences(turns, F.floor(F.col("conv_id") / 2).cast("long"), F.col("conv_id") % 2 == 1)


SQL = """
WITH t AS (SELECT CAST(floor(conv_id / 2.0) AS BIGINT) AS pair_id, conv_id % 2 = 1 AS r, replace(coalesce(role, 'unknown'), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS i FROM conversations),
a AS (SELECT * FROM t WHERE NOT r), b AS (SELECT * FROM t WHERE r), p AS (SELECT DISTINCT pair_id FROM t),
n AS (SELECT pair_id, least((SELECT count(*) FROM a WHERE a.pair_id = p.pair_id), (SELECT count(*) FROM b WHERE b.pair_id = p.pair_id)) AS most FROM p),
d AS (SELECT a.pair_id, min(a.i) - 1 AS n FROM a JOIN b ON a.pair_id = b.pair_id AND a.i = b.i WHERE a.role <> b.role OR a.text <> b.text GROUP BY a.pair_id),
k AS (SELECT n.pair_id, coalesce(d.n, n.most) AS n FROM n LEFT JOIN d ON n.pair_id = d.pair_id),
x AS (SELECT t.*, k.n, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS said FROM t JOIN k ON t.pair_id = k.pair_id),
y AS (SELECT *, sum(length(said)) OVER (PARTITION BY pair_id, r ORDER BY i) AS upto FROM x WHERE i > n),
m AS (SELECT pair_id, string_agg(CASE WHEN NOT r THEN said END, '' ORDER BY i) AS chosen, string_agg(CASE WHEN r THEN said END, '' ORDER BY i) AS rejected,
  string_agg(CASE WHEN NOT r AND role = 'assistant' THEN (upto - length(text) - 8) || '-' || upto END, ',' ORDER BY i) AS chosen_mask,
  string_agg(CASE WHEN r AND role = 'assistant' THEN (upto - length(text) - 8) || '-' || upto END, ',' ORDER BY i) AS rejected_mask FROM y GROUP BY pair_id),
q AS (SELECT pair_id, string_agg(said, '' ORDER BY i) AS prompt FROM x WHERE NOT r AND i <= n GROUP BY pair_id)
SELECT k.pair_id, CAST(k.n AS BIGINT) AS n_common, coalesce(prompt, '') AS prompt, coalesce(chosen, '') AS chosen, coalesce(rejected, '') AS rejected,
  coalesce(chosen_mask, '') AS chosen_mask, coalesce(rejected_mask, '') AS rejected_mask
FROM k LEFT JOIN m ON k.pair_id = m.pair_id LEFT JOIN q ON k.pair_id = q.pair_id
"""
