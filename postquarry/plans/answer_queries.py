"""Annotation queries.

Role: an order is an item, its lines are the coders, return flag and line status are two questions.
Lines that share an order and a line number are answers of different coders: repeats are numbered, and
the coder is the line number plus 8 for each repeat before it (line numbers go up to 7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.operators import annotation as AN
from postquarry.plans.registry import query, table
from postquarry.session import dealt

DOMAINS = {
    "l_returnflag": {"A": "ACCEPTED", "N": "NONE", "R": "RETURNED"},
    "l_linestatus": {"F": "FILLED", "O": "OPEN"},
}
NARROW = {"l_returnflag": ["A", "N"], "l_linestatus": ["F"]}
LINES_SQL = """
    lines AS (SELECT l_orderkey, l_returnflag, l_linestatus, l_suppkey, l_partkey, l_linenumber + 8 * (row_number() OVER (
                     PARTITION BY l_orderkey, l_linenumber ORDER BY l_returnflag, l_linestatus, l_suppkey, l_partkey) - 1) AS l_linenumber
              FROM lineitem)"""
LONG_SQL = f"""{LINES_SQL},
    answers AS (SELECT l_orderkey AS item, 'l_returnflag' AS question, l_returnflag AS answer, l_linenumber AS coder FROM lines
                UNION ALL SELECT l_orderkey, 'l_linestatus', l_linestatus, l_linenumber FROM lines)"""


def coded_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every line with its coder in place of the line number. A group holds the repeats of one line, a few rows.

    Lines are dealt by order, an item, so that all that is grouped by item later on stays in place.
    """
    answers = ["l_returnflag", "l_linestatus", "l_suppkey", "l_partkey"]
    same = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*answers)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *answers)
    lines = dealt(lines, lines, "l_orderkey")
    return lines.withColumn("l_linenumber", F.col("l_linenumber").cast("long") + 8 * (F.row_number().over(same) - 1))


def long_answers(spark: SparkSession, sf: str) -> DataFrame:
    cells = AN.answer_cells(coded_lines(spark, sf), "l_orderkey", "l_linenumber", DOMAINS, [], {})
    return AN.answers_long(cells)


def order_items(spark: SparkSession, sf: str) -> DataFrame:
    """Every order is an item, also one without lines."""
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("item"))


@query("A9 P17 F15 F16 P20", f"""
    WITH {LINES_SQL}, a AS (
        SELECT l_orderkey AS item, 'l_returnflag' AS question, CASE WHEN l_returnflag = 'R' THEN 'A' ELSE l_returnflag END AS answer, l_linenumber AS coder FROM lines
        UNION ALL SELECT l_orderkey, 'l_linestatus', l_linestatus, l_linenumber FROM lines)
    SELECT item, question, answer, string_agg(CAST(coder AS VARCHAR), '; ' ORDER BY CAST(coder AS VARCHAR)) AS coders, count(*) AS n
    FROM a WHERE question = 'l_returnflag' OR answer = 'F' GROUP BY ALL""")
def coder_answers(spark, sf):
    cells = AN.answer_cells(coded_lines(spark, sf), "l_orderkey", "l_linenumber", NARROW, [("l_returnflag", "R", "A")], {})
    return AN.coders_per_answer(AN.answers_long(cells))


BROKEN_SQL = f"""
    WITH {LINES_SQL}, b AS (
        SELECT l_linenumber AS coder, l_orderkey AS item, 'l_returnflag' AS question, l_returnflag AS answer, 'wrong value' AS problem
        FROM lines WHERE l_returnflag = 'R'
        UNION ALL SELECT l_linenumber, l_orderkey, 'l_linestatus', l_linestatus,
                         CASE WHEN l_linestatus <> 'F' THEN 'wrong value' ELSE 'inconsistent' END
        FROM lines WHERE l_linestatus <> 'F' OR l_returnflag = 'N')"""


def narrow_cells(spark: SparkSession, sf: str) -> DataFrame:
    needs = {"l_linestatus": "l_returnflag"}
    return AN.answer_cells(coded_lines(spark, sf), "l_orderkey", "l_linenumber", NARROW, [], needs, "N")


@query("F16 F17", BROKEN_SQL + " SELECT * FROM b")
def broken_cells(spark, sf):
    return AN.broken_cells(narrow_cells(spark, sf))


@query("A10 F17", BROKEN_SQL + " SELECT coder, count(*) AS n_broken, count(DISTINCT item) AS n_items FROM b GROUP BY coder")
def broken_rows(spark, sf):
    return AN.broken_counts(narrow_cells(spark, sf))


@query("A11 U3", f"WITH {LONG_SQL} SELECT question, count(DISTINCT coder) AS n_coders FROM answers GROUP BY question")
def coders_per_question(spark, sf):
    return AN.coders_per_question(long_answers(spark, sf))


@query("A12 A11", f"""
    WITH {LONG_SQL}, c AS (SELECT count(DISTINCT coder) AS n FROM answers WHERE question = 'l_returnflag')
    SELECT o.o_orderkey AS item, count(*) FILTER (WHERE answer = 'A') AS "A", count(*) FILTER (WHERE answer = 'N') AS "N",
           count(*) FILTER (WHERE answer = 'R') AS "R", max(c.n) - count(answer) AS not_coded
    FROM orders o CROSS JOIN c LEFT JOIN answers a ON a.item = o.o_orderkey AND a.question = 'l_returnflag' GROUP BY o.o_orderkey""")
def rating_matrix(spark, sf):
    return AN.rating_matrix(order_items(spark, sf), long_answers(spark, sf), "l_returnflag", list(DOMAINS["l_returnflag"]))


KAPPA_SQL = f"""
    WITH {LONG_SQL}, q AS (SELECT question, CAST(count(DISTINCT coder) AS DOUBLE) AS n FROM answers GROUP BY question),
    cells AS (SELECT o.o_orderkey AS item, q.question, q.n, d.answer,
                     (SELECT count(*) FROM answers a WHERE a.item = o.o_orderkey AND a.question = q.question AND a.answer = d.answer) AS k
              FROM orders o CROSS JOIN q JOIN (SELECT DISTINCT question, answer FROM answers) d ON d.question = q.question),
    filled AS (SELECT item, question, n, answer, CAST(k AS DOUBLE) AS k FROM cells
               UNION ALL SELECT item, question, n, 'not coded', n - sum(k) FROM cells GROUP BY item, question, n),
    agreement AS (SELECT question, avg(p) AS observed FROM (
                      SELECT question, item, (sum(k * k) - max(n)) / (max(n) * (max(n) - 1)) AS p FROM filled GROUP BY question, item) GROUP BY question),
    share AS (SELECT question, answer, sum(k) / sum(sum(k)) OVER (PARTITION BY question) AS p FROM filled GROUP BY question, answer),
    chance AS (SELECT question, sum(p * p) AS expected FROM share GROUP BY question),
    kappa AS (SELECT question, (observed - expected) / (1 - expected) AS k FROM agreement JOIN chance USING (question))
    SELECT k.question, CAST(q.n AS BIGINT) AS n_coders, (SELECT count(*) FROM orders) AS n_items, round(k.k, 3) AS kappa,
           CASE WHEN k.k < 0 THEN 'Poor aggreement' WHEN k.k < 0.2 THEN 'Slight agreement' WHEN k.k < 0.4 THEN 'Fair agreement'
                WHEN k.k < 0.6 THEN 'Moderate agreement' WHEN k.k < 0.8 THEN 'Substantial agreement' ELSE 'Almost perfect agreement' END AS interpretation
    FROM kappa k JOIN q USING (question)"""


@query("A13 A11 P18 P19", KAPPA_SQL)
def fleiss_kappa(spark, sf):
    return AN.fleiss_kappa(order_items(spark, sf), long_answers(spark, sf), DOMAINS)


SPREAD_SQL = f"""WITH {LONG_SQL},
    spread AS (SELECT item, question, min(answer) AS lo, max(answer) AS hi FROM answers GROUP BY item, question),
    split AS (SELECT DISTINCT item FROM spread WHERE lo <> hi)"""


@query("A17 Q7", SPREAD_SQL + " SELECT item, question, lo AS answer FROM spread WHERE lo = hi AND item NOT IN (SELECT item FROM split)")
def agreed(spark, sf):
    return AN.agreed(long_answers(spark, sf), DOMAINS)


@query("A17 Q7", SPREAD_SQL + " SELECT item, question, lo AS answer FROM spread WHERE lo = hi")
def agreed_per_question(spark, sf):
    return AN.agreed(long_answers(spark, sf), DOMAINS, per_item=False)


@query("A17 J8", SPREAD_SQL + """
    SELECT o.o_orderkey, o.o_custkey, CASE WHEN question = 'l_returnflag' THEN lo END AS l_returnflag,
           CASE WHEN question = 'l_linestatus' THEN lo END AS l_linestatus
    FROM spread s JOIN orders o ON o.o_orderkey = s.item WHERE lo = hi AND item NOT IN (SELECT item FROM split)""")
def agreed_wide(spark, sf):
    agreements = AN.agreed(long_answers(spark, sf), DOMAINS)
    meta = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    wide = AN.agreed_wide(agreements, meta, list(DOMAINS), "o_orderkey")
    return wide.withColumnRenamed("item", "o_orderkey")


def _coders_sql(question: str, answer: str, name: str) -> str:
    return (
        f"CASE WHEN bool_or(question = '{question}' AND lo <> hi) THEN string_agg(CAST(coder AS VARCHAR), '; ' ORDER BY CAST(coder AS VARCHAR)) "
        f"FILTER (WHERE question = '{question}' AND answer = '{answer}') END AS \"{question}_{name}\""
    )


DISAGREED_SQL = SPREAD_SQL + " SELECT a.item, o.o_custkey, " + ", ".join(
    _coders_sql(q, code, name) for q, domain in DOMAINS.items() for code, name in domain.items()
) + """ FROM answers a JOIN spread s USING (item, question) JOIN orders o ON o.o_orderkey = a.item
    WHERE a.item IN (SELECT item FROM split) GROUP BY a.item, o.o_custkey"""


@query("A16 J8 P20", DISAGREED_SQL)
def disagreed(spark, sf):
    meta = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return AN.disagreed(long_answers(spark, sf), DOMAINS, meta, "o_orderkey")


@query("A16", SPREAD_SQL + """
    SELECT item, question, answer, string_agg(CAST(coder AS VARCHAR), '; ' ORDER BY CAST(coder AS VARCHAR)) AS coders
    FROM answers JOIN spread USING (item, question) WHERE lo <> hi GROUP BY item, question, answer""")
def disagreed_long(spark, sf):
    return AN.disagreed_long(long_answers(spark, sf))


@query("A23", SPREAD_SQL + """
    SELECT DISTINCT question || '_' || CASE answer WHEN 'A' THEN 'ACCEPTED' WHEN 'N' THEN 'NONE' WHEN 'R' THEN 'RETURNED'
                                                   WHEN 'F' THEN 'FILLED' ELSE 'OPEN' END AS column_name
    FROM answers JOIN spread USING (item, question) WHERE lo <> hi ORDER BY column_name DESC""")
def needed_columns(spark, sf):
    return AN.needed_columns(long_answers(spark, sf), DOMAINS)


EXPORT_SQL = f"""{LINES_SQL},
    export AS (SELECT l_orderkey AS id, l_linenumber AS annotator, nullif(l_suppkey, 0) AS annotation_id,
                      nullif(l_returnflag, 'N') AS flag, l_linestatus AS status, l_partkey AS part FROM lines)"""
CHOICES = {"flag": ["A", "R"], "status": ["F", "O"]}


def tool_export(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as a tool export: supplier 0 means not annotated, flag N means no response."""
    return coded_lines(spark, sf).select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("annotator"), F.nullif("l_suppkey", F.lit(0)).alias("annotation_id"),
        F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.col("l_linestatus").alias("status"), F.col("l_partkey").alias("part"),
    )


def _choice_sql(question: str, option: str) -> str:
    return (
        f"string_agg(coalesce(r_name, CAST(annotator AS VARCHAR)), '; ' ORDER BY coalesce(r_name, CAST(annotator AS VARCHAR))) "
        f"FILTER (WHERE coalesce({question}, '000') = '{option}') AS \"{question}-{option}\""
    )


@query("A14 J9 J10 P21 P20", f"WITH {EXPORT_SQL} SELECT id AS task, arg_min(part, annotator) AS part, " + ", ".join(
    _choice_sql(q, o) for q, options in CHOICES.items() for o in [*options, "000"]
) + " FROM export LEFT JOIN region ON r_regionkey = annotator WHERE annotation_id IS NOT NULL GROUP BY id")
def wide_answers(spark, sf):
    users = table(spark, sf, "region").select(F.col("r_regionkey").alias("user_id"), F.col("r_name").alias("name"))
    return AN.wide_answers(tool_export(spark, sf), CHOICES, ["part"], users, order_col="annotator")


@query("A14 J9", f"""
    WITH {EXPORT_SQL}, d(question, option) AS (VALUES ('flag', 'A'), ('flag', 'R'), ('flag', '000'), ('status', 'F'), ('status', 'O'), ('status', '000')),
    long AS (SELECT id, 'flag' AS question, coalesce(flag, '000') AS option FROM export WHERE annotation_id IS NOT NULL
             UNION ALL SELECT id, 'status', coalesce(status, '000') FROM export WHERE annotation_id IS NOT NULL)
    SELECT t.id AS task, d.question, d.option, count(l.id) AS n
    FROM (SELECT DISTINCT id FROM long) t CROSS JOIN d LEFT JOIN long l ON l.id = t.id AND l.question = d.question AND l.option = d.option
    GROUP BY ALL""")
def choice_counts(spark, sf):
    return AN.choice_counts(AN.choice_answers(tool_export(spark, sf), list(CHOICES)), CHOICES)


@query("F16", f"WITH {EXPORT_SQL} SELECT id AS task, 'flag' AS question, flag AS answer, annotator FROM export WHERE annotation_id IS NOT NULL AND flag = 'R'")
def unknown_choices(spark, sf):
    narrow = {"flag": ["A"], "status": ["F", "O"]}
    return AN.unknown_choices(AN.choice_answers(tool_export(spark, sf), list(narrow)), narrow)


@query("A15 F15", """
    SELECT conv_id AS task, 'question' AS question, turn AS annotator, md5(text) AS text_md5 FROM conversations WHERE role = 'user'
    UNION ALL SELECT conv_id, 'reply', turn, md5(text) FROM conversations WHERE role = 'assistant'""")
def free_text(spark, sf):
    rows = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("id"), F.col("turn").alias("annotator"), F.lit(1).alias("annotation_id"),
        F.when(F.col("role") == "user", F.col("text")).alias("question"), F.when(F.col("role") == "assistant", F.col("text")).alias("reply"),
    )
    return AN.free_text(rows, ["question", "reply"]).select("task", "question", "annotator", F.md5("text").alias("text_md5"))


def doc_tasks(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id", "left")
    return docs.select(F.col("doc_id").alias("id"), "source", F.when(F.col("quality").isNotNull(), F.col("doc_id") + 1).alias("annotation_id"))


@query("A20", """
    SELECT d.source, count(*) AS n_tasks, count(l.doc_id) AS n_annotated_tasks, count(l.doc_id) AS n_annotations
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.source""")
def progress(spark, sf):
    return AN.progress(doc_tasks(spark, sf), "source")


@query("A21 F14", "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_tasks(spark, sf):
    return AN.missing_tasks(doc_tasks(spark, sf))
