"""Answers of several coders: merging, agreement and reports.

The long table ``item, question, answer, coder`` is the working form. What is gathered
into one row (names of coders) is bounded by the number of coders of one item.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.functions import answers as A
from postquarry.session import broadcast_if_small, dealt, small_table

Domains = dict[str, list[str] | dict[str, str]]


def answer_cells(
    df: DataFrame,
    item: str,
    coder: str,
    domains: Domains = A.QUESTIONS,
    fixes: list[tuple[str, str, str]] = A.FIXES,
    class_needs: dict[str, str] | None = None,
    negative: str = A.NOT_RELEVANT,
) -> DataFrame:
    """One row per filled answer: ``item, coder, question, answer, valid, inconsistent``.

    ``valid``: the (rewritten) answer is in the domain of its question. ``inconsistent``:
    a valid class although the matching relevance question was answered negatively.
    """
    needs = A.CLASS_NEEDS if class_needs is None else class_needs

    def cell(question: str) -> Column:
        answer = A.fixed_answer(question, F.col(question), fixes)
        valid = answer.isin(list(domains[question]))
        odd = F.lit(False)
        if question in needs:
            relevance = A.fixed_answer(needs[question], F.col(needs[question]), fixes)
            odd = valid & F.coalesce(relevance == negative, F.lit(False))
        return F.struct(
            F.lit(question).alias("question"), answer.alias("answer"), valid.alias("valid"), odd.alias("inconsistent")
        )

    cells = df.select(
        F.col(item).alias("item"), F.col(coder).alias("coder"), F.explode(F.array(*[cell(q) for q in domains])).alias("cell")
    )
    return cells.select("item", "coder", "cell.*").where(~A.is_blank(F.col("answer")))


def answers_long(cells: DataFrame, drop_inconsistent: bool = False) -> DataFrame:
    """Valid answers as ``item, question, answer, coder``."""
    keep = F.col("valid") & ~F.col("inconsistent") if drop_inconsistent else F.col("valid")
    return cells.where(keep).select("item", "question", "answer", "coder")


def coders_per_answer(answers: DataFrame) -> DataFrame:
    """Coders of every (item, question, answer), joined in order."""
    return answers.groupBy("item", "question", "answer").agg(
        A.joined(F.col("coder").cast("string")).alias("coders"), F.count("*").alias("n")
    )


def coder_map(answers: DataFrame) -> DataFrame:
    """Edge form: per (item, question) a map from answer to the list of coders."""
    lists = answers.groupBy("item", "question", "answer").agg(F.sort_array(F.collect_list("coder")).alias("coders"))
    return lists.groupBy("item", "question").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("answer", "coders")))).alias("coders"))


def broken_cells(cells: DataFrame) -> DataFrame:
    """Wrong codes and inconsistent classes: ``coder, item, question, answer, problem``."""
    problem = F.when(~F.col("valid"), F.lit("wrong value")).when(F.col("inconsistent"), F.lit("inconsistent"))
    return cells.withColumn("problem", problem).where("problem IS NOT NULL").select("coder", "item", "question", "answer", "problem")


def broken_counts(cells: DataFrame) -> DataFrame:
    """Broken answers and the items touched, per coder."""
    return broken_cells(cells).groupBy("coder").agg(
        F.count("*").alias("n_broken"), F.countDistinct("item").alias("n_items")
    )


def coders_per_question(answers: DataFrame) -> DataFrame:
    return answers.groupBy("question").agg(F.countDistinct("coder").alias("n_coders"))


def rating_matrix(items: DataFrame, answers: DataFrame, question: str, domain: list[str], item: str = "item") -> DataFrame:
    """Counts per item and class in domain order, and the coders who gave none.

    Every item has a row, also one nobody coded.
    """
    asked = answers.where(F.col("question") == question)
    counts = asked.groupBy("item").agg(*[F.count_if(F.col("answer") == c).alias(c) for c in domain])
    n_coders = asked.agg(F.countDistinct("coder")).scalar()
    filled = [F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in domain]
    full = items.select(F.col(item).alias("item")).distinct().join(counts, "item", "left").select("item", *filled)
    coded = reduce(lambda a, b: a + b, [F.col(c) for c in domain])
    return full.withColumn("not_coded", n_coders - coded)


def fleiss_kappa(items: DataFrame, answers: DataFrame, domains: Domains, item: str = "item") -> DataFrame:
    """Fleiss' kappa per question, with "not coded" as one more category.

    With n coders, N items and n_ij ratings of item i for class j, s_i = sum_j n_ij, the
    not-coded cell of an item is n - s_i. Its square expands to n^2 - 2 n s_i + s_i^2,
    so the statistic needs only plain sums over items: they are combined map-side and n
    enters at the end, once per question. Undefined (null) for n < 2 or when chance
    agreement is 1. Answers on anything but the items do not count; items are as many as answers
    at times, so they are never broadcast.
    """
    listed = items.select(F.col(item).alias("item"))
    answers = answers.join(dealt(listed, listed, "item").hint("merge"), "item", "left_semi")
    classes = sorted({code for domain in domains.values() for code in domain})
    per_item = answers.groupBy("question", "item").agg(
        *[F.count_if(F.col("answer") == c).cast("double").alias(f"c{i}") for i, c in enumerate(classes)]
    )
    cols = [F.col(f"c{i}") for i in range(len(classes))]
    total = reduce(lambda a, b: a + b, cols)
    squares = reduce(lambda a, b: a + b, [c * c for c in cols])
    sums = per_item.groupBy("question").agg(
        F.sum(total).alias("s1"), F.sum(total * total).alias("s2"), F.sum(squares).alias("ss"),
        *[F.sum(c).alias(f"t{i}") for i, c in enumerate(cols)],
    )
    n_items = dealt(listed, listed, "item").agg(F.countDistinct("item")).scalar().cast("double")
    asked = small_table(answers.sparkSession, [(q,) for q in domains], ["question"])
    n = F.col("n_coders").cast("double")
    joined = (
        asked.join(sums, "question", "left").join(coders_per_question(answers), "question", "left")
        .withColumn("n_items", n_items)
    )
    big_n = F.col("n_items")
    ratings = big_n * n
    cell_squares = F.col("ss") + big_n * n * n - 2 * n * F.col("s1") + F.col("s2")
    observed = (cell_squares / big_n - n) / (n * (n - 1))
    shares = [F.pow(F.col(f"t{i}") / ratings, 2) for i in range(len(classes))]
    chance = reduce(lambda a, b: a + b, shares) + F.pow((ratings - F.col("s1")) / ratings, 2)
    kappa = F.when((n >= 2) & (F.abs(1 - F.col("chance")) > 1e-12), (F.col("observed") - F.col("chance")) / (1 - F.col("chance")))
    ready = joined.select(
        "question",
        F.coalesce("n_coders", F.lit(0).cast("bigint")).alias("n_coders"),
        F.col("n_items").cast("bigint").alias("n_items"),
        F.when(n >= 2, observed).alias("observed"),
        chance.alias("chance"),
    )
    return ready.select(
        "question", "n_coders", "n_items",
        F.round(kappa, 3).alias("kappa"), A.kappa_band(kappa).alias("interpretation"),
    )


def _spread(domains: Domains) -> tuple[list[Column], Column]:
    """Aggregates giving the lowest and highest answer per question, and "any question differs".

    Answers are compared by their place in the domain: numbers aggregate in place in a
    hash table, text would have to be sorted. Codes outside the domain do not count.
    """
    aggs, differs = [], []
    for i, (question, domain) in enumerate(domains.items()):
        place = F.nullif(F.array_position(F.array(*[F.lit(c) for c in domain]), F.col("answer")), F.lit(0)).cast("int")
        here = F.when(F.col("question") == question, place)
        aggs += [F.min(here).alias(f"lo{i}"), F.max(here).alias(f"hi{i}")]
        differs.append(_differs(i))
    return aggs, reduce(lambda a, b: a | b, differs)


def _differs(i: int) -> Column:
    return F.coalesce(F.col(f"lo{i}") != F.col(f"hi{i}"), F.lit(False))


def agreed(answers: DataFrame, domains: Domains, per_item: bool = True) -> DataFrame:
    """Questions with exactly one answer among the coders: ``item, question, answer``.

    With ``per_item`` an item that disagrees on any question gives no rows at all.
    """
    aggs, any_differs = _spread(domains)
    spread = answers.groupBy("item").agg(*aggs)
    if per_item:
        spread = spread.where(~any_differs)
    cells = []
    for i, (question, domain) in enumerate(domains.items()):
        code = F.element_at(F.array(*[F.lit(c) for c in domain]), F.col(f"lo{i}"))
        cells.append(F.struct(F.lit(question).alias("question"), F.when(F.col(f"lo{i}") == F.col(f"hi{i}"), code).alias("answer")))
    return spread.select("item", F.explode(F.array(*cells)).alias("c")).select("item", "c.*").where("answer IS NOT NULL")


def agreed_wide(agreements: DataFrame, meta: DataFrame, questions: list[str], item: str = "item") -> DataFrame:
    """One row per (item, question), the answer in the column of its question, beside the item's columns."""
    answer = [F.when(F.col("question") == q, F.col("answer")).alias(q) for q in questions]
    return agreements.join(meta.withColumnRenamed(item, "item"), "item").select(*["item" if c == item else c for c in meta.columns], *answer)


def column_name(question: str, code: str, domain: list[str] | dict[str, str]) -> str:
    return f"{question}_{domain[code] if isinstance(domain, dict) else code}"


def disagreed(answers: DataFrame, domains: Domains, meta: DataFrame | None = None, item: str = "item") -> DataFrame:
    """Items with differing answers: a column per question and class that lists its coders.

    Only questions that disagree are filled. Columns are sorted in descending order
    after the item columns.
    """
    aggs, any_differs = _spread(domains)
    names = {}
    for i, (question, domain) in enumerate(domains.items()):
        for code in domain:
            name = column_name(question, code, domain)
            names[name] = i
            coder = F.when((F.col("question") == question) & (F.col("answer") == code), F.col("coder").cast("string"))
            aggs.append(A.joined(coder).alias(name))
    rows = answers.groupBy("item").agg(*aggs).where(any_differs)
    ordered = sorted(names, reverse=True)
    rows = rows.select("item", *[F.when(_differs(names[n]), F.col(n)).alias(n) for n in ordered])
    if meta is None:
        return rows
    joined = meta.withColumnRenamed(item, "item").join(rows, "item")
    return joined.select(*["item" if c == item else c for c in meta.columns], *ordered)


def disagreed_long(answers: DataFrame) -> DataFrame:
    """Disagreements without a fixed domain: ``item, question, answer, coders``.

    Listing the coders and counting the answers both work within a placement by item,
    if the rows come with one (see ``session.dealt``).
    """
    answers_here = F.count("*").over(Window.partitionBy("item", "question"))
    listed = coders_per_answer(answers).withColumn("_answers", answers_here)
    return listed.where("_answers > 1").select("item", "question", "answer", "coders")


def needed_columns(answers: DataFrame, domains: Domains) -> DataFrame:
    """The (question, class) columns disagreements really use, in descending order."""
    used = disagreed_long(answers).select("question", "answer").distinct()
    pairs = [(q, code, column_name(q, code, domains[q])) for q in domains for code in domains[q]]
    named = small_table(answers.sparkSession, pairs, ["question", "answer", "column_name"])
    return used.join(named, ["question", "answer"]).select("column_name").orderBy(F.desc("column_name"))


# Tool exports: one record per task and annotator.


def is_annotated(annotation_id: str = "annotation_id") -> Column:
    return F.coalesce(F.col(annotation_id) != 0, F.lit(False))


def missing_tasks(export: DataFrame, task: str = "id", annotation_id: str = "annotation_id") -> DataFrame:
    """Tasks that have a record without an annotation."""
    return export.where(~is_annotated(annotation_id)).select(task).distinct()


def choice_answers(export: DataFrame, questions: list[str], task: str = "id", annotator: str = "annotator", annotation_id: str = "annotation_id") -> DataFrame:
    """Long form of an export: ``task, question, answer, annotator``; ``000`` where nothing was chosen."""
    cells = [
        F.struct(F.lit(q).alias("question"), F.coalesce(F.col(q).cast("string"), F.lit(A.NO_RESPONSE)).alias("answer")) for q in questions
    ]
    annotated = export.where(is_annotated(annotation_id))
    return annotated.select(F.col(task).alias("task"), F.col(annotator).alias("annotator"), F.explode(F.array(*cells)).alias("c")).select(
        "task", "c.*", "annotator"
    )


def _with_no_response(domain: list[str] | dict[str, str]) -> list[str]:
    return [*domain, A.NO_RESPONSE]


def unknown_choices(choices: DataFrame, domains: Domains) -> DataFrame:
    """Chosen options that are not in the domain of their question."""
    known = reduce(
        lambda a, b: a | b,
        [(F.col("question") == q) & F.col("answer").isin(_with_no_response(d)) for q, d in domains.items()],
    )
    return choices.where(~known)


def choice_counts(choices: DataFrame, domains: Domains) -> DataFrame:
    """Annotators per (task, question, option), 0 for options nobody chose."""
    per_task = choices.groupBy("task").agg(*[
        F.count_if((F.col("question") == q) & (F.col("answer") == o)).alias(f"{q}-{o}")
        for q, d in domains.items() for o in _with_no_response(d)
    ])
    cells = [
        F.struct(F.lit(q).alias("question"), F.lit(o).alias("option"), F.col(f"`{q}-{o}`").alias("n"))
        for q, d in domains.items() for o in _with_no_response(d)
    ]
    return per_task.select("task", F.explode(F.array(*cells)).alias("c")).select("task", "c.*")


def wide_answers(
    export: DataFrame,
    domains: Domains,
    inputs: list[str] | None = None,
    users: DataFrame | None = None,
    task: str = "id",
    annotator: str = "annotator",
    annotation_id: str = "annotation_id",
    order_col: str | None = None,
) -> DataFrame:
    """One row per task with a ``question-option`` column listing who chose it.

    Inputs come from the task's first record (lowest ``order_col``, by default the
    annotation id). ``users`` (``user_id, name``) gives display names; a user without
    one appears as the id.
    """
    inputs = inputs or []
    annotated = export.where(is_annotated(annotation_id)).withColumn("_who", F.col(annotator).cast("string"))
    if users is not None:
        named = broadcast_if_small(users.select(F.col("user_id").alias(annotator), F.col("name").alias("_name")))
        annotated = annotated.join(named, annotator, "left").withColumn("_who", A.user_name(F.col("_name"), F.col(annotator)))
    first = F.col(order_col or annotation_id)
    aggs = [F.min_by(F.col(i), first).alias(i) for i in inputs]
    for q, domain in domains.items():
        answer = F.coalesce(F.col(q).cast("string"), F.lit(A.NO_RESPONSE))
        for option in _with_no_response(domain):
            aggs.append(A.joined(F.when(answer == option, F.col("_who"))).alias(f"{q}-{option}"))
    return annotated.groupBy(F.col(task).alias("task")).agg(*aggs)


def free_text(export: DataFrame, text_cols: list[str], task: str = "id", annotator: str = "annotator", annotation_id: str = "annotation_id") -> DataFrame:
    """Free-text answers: ``task, question, annotator, text``; blanks drop out."""
    cells = [F.struct(F.lit(c).alias("question"), F.col(c).alias("text")) for c in text_cols]
    rows = export.where(is_annotated(annotation_id)).select(
        F.col(task).alias("task"), F.col(annotator).alias("annotator"), F.explode(F.array(*cells)).alias("c")
    )
    return rows.select("task", "c.question", "annotator", "c.text").where(~A.is_blank(F.col("text")))


def free_text_map(texts: DataFrame) -> DataFrame:
    """Edge form: per (task, question) a map from annotator to text."""
    last = texts.groupBy("task", "question", "annotator").agg(F.max("text").alias("text"))
    return last.groupBy("task", "question").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("annotator", "text")))).alias("texts"))


def progress(export: DataFrame, project: str, task: str = "id", annotation_id: str = "annotation_id") -> DataFrame:
    """Per project: tasks, tasks with an annotation, annotations."""
    per_task = export.groupBy(project, task).agg(F.count_if(is_annotated(annotation_id)).alias("_n"))
    return per_task.groupBy(project).agg(
        F.count("*").alias("n_tasks"),
        F.count_if(F.col("_n") > 0).alias("n_annotated_tasks"),
        F.sum("_n").alias("n_annotations"),
    )
