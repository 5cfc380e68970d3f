"""Text queries over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.catalog.base import query
from tablework.functions import text
from tablework.sources.retail import table

NEWEST = 1000

_IS_QUESTION = "(" + " OR ".join(
    "contains(lower(text), '" + k.lower().replace("'", "''") + "')" for k in text.QUESTION_KEYWORDS) + ")"


@query("question_flag", f"""
SELECT 'documents' AS origin, doc_id AS id, CAST(0 AS BIGINT) AS turn, {_IS_QUESTION} AS is_question FROM documents
UNION ALL SELECT 'conversations', conv_id, turn, {_IS_QUESTION} FROM conversations""")
def _(spark, sf_dir):
    flag = text.looks_like_question(F.col("text")).alias("is_question")
    documents = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), flag)
    turns = table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("origin"), F.col("conv_id").alias("id"), "turn", flag)
    return documents.unionByName(turns)


@query("newest_questions", f"""
SELECT count(*) AS newest, count(*) FILTER ({_IS_QUESTION}) AS matched
FROM (SELECT * FROM documents ORDER BY doc_id DESC LIMIT {NEWEST})""")
def _(spark, sf_dir):
    newest = (table(spark, sf_dir, "documents").select("doc_id", "text")
              .orderBy(F.col("doc_id").desc_nulls_last()).limit(NEWEST))
    return newest.agg(F.count("*").alias("newest"),
                      F.count_if(text.looks_like_question(F.col("text"))).alias("matched"))


_BLANKS = "'" + text.PYTHON_BLANKS + "'"


@query("reply_split", f"""
SELECT conv_id, turn,
       trim(replace(split_part(reply, 'Caption:', 1), 'Image prompt:', ''), {_BLANKS}) AS image_prompt,
       trim(trim(split_part(reply, 'Caption:', 2), {_BLANKS}), '''"') AS caption
FROM (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'Image prompt: ' || text || chr(10) || ' Caption: "' || text || '"' || chr(9)
                                 ELSE 'Image prompt:' || text END AS reply FROM conversations)""")
def _(spark, sf_dir):
    body = F.col("text")
    reply = (F.when(F.col("turn") % 2 == 0, F.concat(F.lit("Image prompt: "), body, F.lit('\n Caption: "'), body,
                                                     F.lit('"\t')))
             .otherwise(F.concat(F.lit("Image prompt:"), body)))
    replies = table(spark, sf_dir, "conversations").select("conv_id", "turn", reply.alias("reply"))
    return replies.select("conv_id", "turn", text.reply_prompt(F.col("reply")).alias("image_prompt"),
                          text.reply_caption(F.col("reply")).alias("caption"))
