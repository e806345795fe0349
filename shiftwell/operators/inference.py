"""Asking a model about every row, once per distinct prompt.

Column models are projections: nothing is shuffled, and Python runs only where the
model's own expression has a pandas function in it, as that of ``hash_embedding``. Batch
models are asked through a second, deduplicated frame:

    rows -> distinct prompt inputs -> model, in tasks -> answers, written
    rows -- left join on the inputs' hash ----------------> rows with answers

The distinct step folds repeats inside each task before it shuffles, so an input
shared by a third of all rows arrives as one row per task. The answers are
written to the shared scratch folder, so neither a lost executor nor a second
use of the result asks again. Their size is measured by that write: a small
answer table is broadcast, any other is joined by sort and merge, with the rows
as the side whose hot keys adaptive execution can split over several tasks. Rows
without a prompt get a key of their own and so do not meet in one partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shiftwell.functions.prompts import Prompt
from shiftwell.operators.answers import AnswerStore, answer_key
from shiftwell.operators.calls import OK, model_task
from shiftwell.operators.models import BatchModel, ColumnModel, Model
from shiftwell.session import scratch_path

# The kinds of result and their Spark types.
KINDS = {"bool": "boolean", "double": "double", "string": "string"}

NULL_PROMPT = "null prompt"
NO_ANSWER = "no answer"
UNREADABLE = "unreadable answer"
BROADCAST_BYTES = 8 * 1024 * 1024
SLOTS_A_TASK = 64
# What a call costs besides its text, in bytes of text.
ROW_BYTES = 64
_KEY = "__prompt_key"
_HAS_KEY = "__prompt_asked"


@dataclass(frozen=True)
class Question:
    """One output column: a prompt, the kind of its result and who answers."""

    name: str
    prompt: Prompt
    kind: str
    model: Model

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"kind must be one of {', '.join(KINDS)}, not {self.kind}")


def parsed(raw: Column, kind: str) -> Column:
    """An answer as the asked type; text that is no such value gives NULL."""
    return raw if kind == "string" else raw.try_cast(KINDS[kind])


def _result(raw: Column, status: Column, kind: str) -> Column:
    value = parsed(raw, kind)
    unreadable = raw.isNotNull() & value.isNull()
    return F.struct(
        value.alias("result"),
        raw.cast("string").alias("full_response"),
        F.when(unreadable, UNREADABLE).otherwise(status).alias("status"),
    )


def results(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace answer structs by their ``result``."""
    return frame.withColumns({name: F.col(f"{name}.result") for name in names})


def generate(
    rows: DataFrame,
    questions: Sequence[Question],
    store: AnswerStore | None = None,
    tasks: int | None = None,
    reread: bool = False,
) -> DataFrame:
    """Add a struct(result, full_response, status) column for each question.

    A NULL prompt gives a NULL result with status ``null prompt`` and no call.
    Batch models are called here, in ``tasks`` tasks; column models are part of the
    returned plan. With a store only prompts it does not know are asked, and later
    runs reuse the answers; there a model is known by its name, so models that differ
    must not share one. ``rows`` are read several times for batch models and are
    written to the scratch folder first, unless ``reread`` says that they come from a
    table as they are. Keep only columns needed later: they travel through the join.
    """
    by_name: dict[str, Model] = {}
    for question in questions:
        if by_name.setdefault(question.model.name, question.model) != question.model:
            raise ValueError(f"two models are named {question.model.name}")
    if not reread and any(isinstance(q.model, BatchModel) for q in questions):
        rows = _written(rows)
    out = _by_columns(rows, [q for q in questions if isinstance(q.model, ColumnModel)])
    batch = [q for q in questions if isinstance(q.model, BatchModel)]
    if batch and store is not None:
        for question in batch:
            out = _through_store(out, rows, question, store, tasks)
    elif batch:
        groups: dict[frozenset[tuple[str, str]], list[Question]] = {}
        for question in batch:
            groups.setdefault(frozenset(question.prompt.inputs), []).append(question)
        for group in groups.values():
            out = _by_batch(out, rows, group, tasks)
    return out


def _by_columns(rows: DataFrame, questions: Sequence[Question]) -> DataFrame:
    shared: dict[str, Column] = {}
    answered: dict[str, Column] = {}
    for question in questions:
        prompt, model = question.prompt, question.model
        shared |= {name: work(prompt.values) for name, work in model.shared.items()}
        values = prompt.values | {name: F.col(name) for name in model.shared}
        raw = F.when(prompt.complete(), model.answer(values))
        status = (
            F.when(~prompt.complete(), NULL_PROMPT).when(raw.isNull(), NO_ANSWER).otherwise(OK)
        )
        answered[question.name] = _result(raw, status, question.kind)
    prepared = rows.withColumns(shared) if shared else rows
    return prepared.select(*rows.columns, *(c.alias(name) for name, c in answered.items()))


def _hash(texts: Sequence[Column]) -> Column:
    """A key of one or more texts; NULL when one is NULL."""
    parts = (F.concat(F.length(text).cast("string"), F.lit(":"), text) for text in texts)
    return F.sha2(F.concat(*parts), 256)


def _spread(key: Column, rows: DataFrame) -> Column:
    """The key, or for rows without one a key that fits no answer."""
    return F.coalesce(key, F.xxhash64(*rows.columns).cast("string"))


def _tasks(rows: DataFrame, tasks: int | None) -> int:
    """Model calls are slow for their size, so their task count is set, not
    derived from bytes as adaptive coalescing would."""
    return tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _written(rows: DataFrame) -> DataFrame:
    """The rows as a table, so that nothing below them is computed again."""
    path = scratch_path(rows.sparkSession, "rows")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _ask(
    asked: DataFrame, models: Sequence[BatchModel], prompts: Sequence[Column], answer: str, tasks: int
) -> DataFrame:
    """(key, inputs) to (key, a0, s0, ..) with one call per row and model.

    Prompts are made behind the exchange, which carries each input once. Spark bounds
    the bytes of the batches that tasks get.
    """
    fields = ", ".join(f"a{i} {answer}, s{i} string" for i in range(len(models)))
    dealt = _dealt(_written(asked), tasks)
    rendered = dealt.select("key", *(prompt.alias(f"p{i}") for i, prompt in enumerate(prompts)))
    return rendered.mapInPandas(model_task(list(models)), f"key string, {fields}")


def _dealt(asked: DataFrame, tasks: int) -> DataFrame:
    """The rows in ``tasks`` partitions of near equal bytes.

    Rows fall into many times more slots than tasks by a hash of their key. The slots'
    bytes, a number of rows that depends on the tasks alone, come to the driver, which
    gives the heaviest slot left to the lightest task; so a task is above the others by
    a slot at most, or by one input that is longer than a task's share.
    """
    texts = [name for name in asked.columns if name != "key"]
    size = reduce(Column.__add__, (F.octet_length(name).cast("bigint") for name in texts))
    slot = F.pmod(F.xxhash64("key"), F.lit(tasks * SLOTS_A_TASK)).cast("int")
    weighed = asked.groupBy(slot.alias("slot")).agg(F.sum(size + ROW_BYTES).alias("bytes"))
    loads = [(0, task) for task in range(tasks)]
    place = [0] * (tasks * SLOTS_A_TASK)
    for row in sorted(weighed.collect(), key=lambda row: (-row.bytes, row.slot)):
        load, task = heappop(loads)
        place[row.slot] = task
        heappush(loads, (load + row.bytes, task))
    task = F.element_at(F.lit(place), slot + 1)
    return asked.repartitionById(tasks, task)


def _kept(answers: DataFrame) -> DataFrame:
    """The answers as a written table, marked for the join their size allows."""
    spark = answers.sparkSession
    sizes = [
        F.size(name) * 8 if kind.startswith("array") else F.octet_length(name)
        for name, kind in answers.dtypes
    ]
    row_size = reduce(Column.__add__, (F.coalesce(size, F.lit(0)) for size in sizes))
    seen = Observation()
    path = scratch_path(spark, "answers")
    answers.observe(seen, F.sum(row_size.cast("bigint") + 100).alias("bytes")).write.parquet(path)
    allowed = spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    small = allowed and (seen.get["bytes"] or 0) <= BROADCAST_BYTES
    return spark.read.parquet(path).hint("broadcast" if small else "merge")


def _by_batch(
    out: DataFrame, rows: DataFrame, questions: Sequence[Question], tasks: int | None
) -> DataFrame:
    """Ask about ``rows`` and join the answers to ``out``, the rows as answered so far."""
    inputs = list(questions[0].prompt.inputs.items())
    names = [f"i{n}" for n in range(len(inputs))]
    texts = {pair: F.col(name) for (pair, _), name in zip(inputs, names, strict=True)}

    asked = (
        rows.select([column.alias(name) for (_, column), name in zip(inputs, names, strict=True)])
        .where(reduce(Column.__and__, (F.col(name).isNotNull() for name in names)))
        .distinct()
        .select(_hash([F.col(name) for name in names]).alias("key"), *names)
    )
    prompts = [q.prompt.render(texts) for q in questions]
    models = [q.model for q in questions]
    answers = _kept(_ask(asked, models, prompts, "string", _tasks(rows, tasks)))
    keyed = _keyed(out, _hash([column for _, column in inputs]), rows)
    structs = [
        _result(F.col(f"a{i}"), _status(F.col(f"s{i}")), q.kind).alias(q.name)
        for i, q in enumerate(questions)
    ]
    return _joined(keyed, answers).select(*out.columns, *structs)


def _keyed(out: DataFrame, key: Column, rows: DataFrame) -> DataFrame:
    """The rows with the key of their answer, and whether they have one."""
    return out.withColumns({_KEY: _spread(key, rows), _HAS_KEY: key.isNotNull()})


def _status(status: Column) -> Column:
    """A row's status: that of its answer, or why there is none."""
    return F.when(~F.col(_HAS_KEY), NULL_PROMPT).otherwise(F.coalesce(status, F.lit(NO_ANSWER)))


def _joined(keyed: DataFrame, answers: DataFrame) -> DataFrame:
    answers = answers.withColumnRenamed("key", "__answer_key")
    return keyed.join(answers, F.col(_KEY) == F.col("__answer_key"), "left")


def _through_store(
    out: DataFrame,
    rows: DataFrame,
    question: Question,
    store: AnswerStore,
    tasks: int | None,
) -> DataFrame:
    """As ``_by_batch`` for one question, with the store's answers.

    The answers needed are copied out of the store, which goes on to change.
    """
    model, text = question.model, question.prompt.render()
    asked = (
        rows.select(text.alias("p0"))
        .where(F.col("p0").isNotNull())
        .distinct()
        .select(answer_key(model.name, F.col("p0")).alias("key"), "p0")
    )
    stored = _stored(asked, model, model.name, store, "string", _tasks(rows, tasks))
    answers = _kept(stored)
    keyed = _keyed(out, answer_key(model.name, text), rows)
    answer = _result(F.col("answer"), _status(F.col("status")), question.kind)
    return _joined(keyed, answers).select(*out.columns, answer.alias(question.name))


def _stored(
    asked: DataFrame, model: BatchModel, name: str, store: AnswerStore, kind: str, tasks: int
) -> DataFrame:
    """key, answer and status of every prompt of ``asked``, new ones asked and kept.

    The prompts are written once: their keys choose what is read of the store, twice
    they meet its rows. What is asked now is written before it is kept and is not read
    back from the store.
    """
    spark = asked.sparkSession
    asked = _written(asked)
    known = store.known(spark, name, asked)
    fresh = asked.join(known.hint("merge"), "key", "left_anti")
    now = _ask(fresh, [model], [F.col("p0")], kind, tasks)
    now = _written(now.withColumn("a0", F.to_json("a0")) if kind != "string" else now)
    store.add(now, name)
    told = now.select("key", F.col("a0").alias("answer"), F.col("s0").alias("status"))
    met = asked.select("key").join(known.hint("merge"), "key")
    return met.unionByName(told)


def embed(
    rows: DataFrame,
    text: str,
    model: Model,
    out: str = "embedding",
    tasks: int | None = None,
    dedupe: bool | None = None,
    store: AnswerStore | None = None,
    status: str | None = None,
) -> DataFrame:
    """Add a vector for a text column, and with ``status`` a column that tells why not.

    With ``dedupe`` each distinct text is embedded once, here and now, and the
    vectors are joined back. Batch models always do so; with a store they are asked
    only for texts it does not know. For column models it pays when few texts stand
    for many rows, and is off unless asked for. NULL texts, and texts the model
    failed on, have a NULL vector; the status is ``ok``, ``null prompt``, ``no answer``
    or the error.
    """
    said = [status] if status else []
    column_model = isinstance(model, ColumnModel)
    if column_model and not dedupe:
        vector = _vector(model, F.col(text))
        told = F.when(F.col(text).isNull(), NULL_PROMPT).when(vector.isNull(), NO_ANSWER)
        added = {out: vector} | {name: told.otherwise(OK) for name in said}
        return rows.withColumns(added)
    name = f"{model.name}/vectors"
    key = answer_key(name, F.col(text))
    asked = (
        rows.select(key.alias("key"), F.col(text).alias("p0"))
        .where(F.col("p0").isNotNull())
        .distinct()
    )
    if column_model:
        vector = _vector(model, F.col("p0")).alias("a0")
        answers = asked.select("key", vector, F.lit(OK).alias("s0"))
    elif store is None:
        answers = _ask(asked, [model], [F.col("p0")], "array<double>", _tasks(rows, tasks))
    else:
        # The store keeps texts: a vector is kept as JSON, which gives back each number.
        stored = _stored(asked, model, name, store, "array<double>", _tasks(rows, tasks))
        answers = stored.select(
            "key",
            F.from_json("answer", "array<double>").alias("a0"),
            F.col("status").alias("s0"),
        )
    keyed = _keyed(rows, key, rows)
    missing = F.when(F.col("a0").isNull() & (F.col("s0") == OK), NO_ANSWER)
    told = [F.coalesce(missing, _status(F.col("s0"))).alias(name) for name in said]
    joined = _joined(keyed, _kept(answers))
    return joined.select(*rows.columns, F.col("a0").alias(out), *told)


def _vector(model: ColumnModel, text: Column) -> Column:
    return F.when(text.isNotNull(), model.answer({"text": text}))


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column."""
    return rows.select(column).distinct()
