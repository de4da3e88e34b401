"""Batch inference over a table of prompts."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions import prompts, text, workers
from winnow.functions.text import STOP_TOKEN
from winnow.session import materialize

# Request parameters used where a row leaves them out.
MAX_TOKENS = 200
TEMPERATURE = 0.0

Generator = Callable[[Sequence[dict]], Sequence[str]]


def echo_generator() -> Generator:
    """Stand-in for a model: answers every request with its own prompt and a stop marker, as often as it asks for."""

    def generate(requests: Sequence[dict]) -> list[str]:
        wanted = ((f"{r['prompt']}{STOP_TOKEN} unread", r["candidate_count"]) for r in requests)
        return [json.dumps({"predictions": [{"candidates": [{"text": t}] * n}]}) for t, n in wanted]

    return generate


def requests(df: DataFrame, instruction: str = "prompt", style: str = "serving") -> DataFrame:
    """Put the template around the instruction and fill in the request defaults.

    Columns ``temperature``, ``max_tokens``, ``stop`` and ``candidate_count`` of the input are used
    where they are present and not null.
    """
    defaults = {
        "temperature": F.lit(TEMPERATURE),
        "max_tokens": F.lit(MAX_TOKENS),
        "stop": F.lit(STOP_TOKEN),
        "candidate_count": F.lit(1),
    }
    kinds = {"temperature": "double", "max_tokens": "int", "stop": "string", "candidate_count": "int"}
    filled = {
        name: F.coalesce(F.col(name).cast(kinds[name]), default) if name in df.columns else default
        for name, default in defaults.items()
    }
    return df.withColumns({**filled, "request": prompts.format_prompt(instruction, style=style)})


REQUEST = ("request", "temperature", "max_tokens", "stop", "candidate_count")
WRITTEN = "digest string, reply string, error string, attempts int, run bigint"
BATCH_CHARS = 20_000  # of prompts that are sent at a time
ATTEMPTS = 3
WAIT_SECONDS = 0.05  # before the second attempt, twice as long before each further one


def digests(ready: DataFrame) -> DataFrame:
    """``requests`` with ``digest``: what is asked, and how; equal requests have one."""
    return ready.withColumn("digest", F.when(F.col("request").isNotNull(), F.sha2(F.to_json(F.struct(*REQUEST)), 256)))


def batches_of(sizes: Sequence[int], most: int) -> Iterator[slice]:
    """Runs of requests of at most ``most`` characters together, one request at least."""
    begin = size = 0
    for i, n in enumerate(sizes):
        if i > begin and size + n > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def _asked(generator: Generator, sent: list[dict], attempts: int, wait: float) -> list[tuple[str | None, str | None, int]]:
    """(reply, error, attempts) of each request.  A batch that fails is halved until each failure stands alone, and a request
    that fails alone is tried again, so one bad request costs no other its answer."""
    tried = attempts if len(sent) == 1 else 1
    for attempt in range(1, tried + 1):
        try:
            return [(reply, None, attempt) for reply in workers.as_many(sent, generator(sent), "replies")]
        except Exception as error:
            if len(sent) == 1 and attempt == tried:
                return [(None, f"{type(error).__name__}: {error}", attempt)]
            if len(sent) == 1:
                time.sleep(wait * 2 ** (attempt - 1))
    half = len(sent) // 2
    return _asked(generator, sent[:half], attempts, wait) + _asked(generator, sent[half:], attempts, wait)


def send(
    df: DataFrame,
    path: str,
    load: Callable[[], Generator] = echo_generator,
    instruction: str = "prompt",
    style: str = "serving",
    model: str | None = None,
    batch_chars: int = BATCH_CHARS,
    attempts: int = ATTEMPTS,
    wait: float = WAIT_SECONDS,
) -> DataFrame:
    """``df`` with ``request``, ``digest``, ``reply``, ``answers``, ``answer``, ``error`` and ``runs``, from replies kept in ``path``.

    A request that has a reply there, from this run or an earlier one, is not sent again; requests that are equal are sent once.
    The others go out in batches of ``batch_chars`` characters and each leaves a row in ``path``: a reply, or after
    ``attempts`` attempts an error.  So every prompt has one answer or one error, a failure fails no job, and calling
    again sends only what failed or was not reached.  ``runs`` says in how many runs a request was sent.  Rows with a null
    prompt have no request and none of the rest.

    A task that is run again sends its requests again; its replies count once.  Keep one writer to a path at a time.  Columns
    named like a result are replaced.
    """
    spark = df.sparkSession
    df = df.drop(*({"request", "digest", "reply", "answers", "answer", "error", "runs"} - {instruction}))
    ready = digests(requests(df, instruction, style))
    _ensure(spark, path)
    before = spark.read.schema(WRITTEN).parquet(path)
    answered = before.where("reply IS NOT NULL").select("digest").distinct()
    asked = ready.where("digest IS NOT NULL").select("digest", *REQUEST).dropDuplicates(["digest"])
    # written first: while replies are appended, what is to be sent must not be worked out again
    due = materialize(asked.join(answered, "digest", "left_anti"), "requests")
    number = (before.agg(F.max("run")).first()[0] or 0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        generator = workers.kept(model, load)
        for batch in batches:
            names = ["prompt", *REQUEST[1:]]
            sent = [dict(zip(names, row)) for row in zip(*(batch.column(c).to_pylist() for c in REQUEST))]
            for part in batches_of([len(r["prompt"]) for r in sent], batch_chars):
                found = _asked(generator, sent[part], attempts, wait)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("digest").slice(part.start, part.stop - part.start),
                        pa.array([r for r, _, _ in found], pa.string()),
                        pa.array([e for _, e, _ in found], pa.string()),
                        pa.array([n for _, _, n in found], pa.int32()),
                        pa.array([number] * len(found), pa.int64()),
                    ],
                    ["digest", "reply", "error", "attempts", "run"],
                )

    due.mapInArrow(run, WRITTEN).write.mode("append").parquet(path)
    last = spark.read.schema(WRITTEN).parquet(path).groupBy("digest").agg(
        F.max_by(F.struct("reply", "error"), F.struct(F.col("reply").isNotNull(), "run")).alias("_last"),
        F.count_distinct("run").alias("runs"),
    )
    joined = ready.join(last, "digest", "left").select("*", "_last.reply", "_last.error")
    return _with_answers(joined, df, "request", "digest", more=("error", "runs"))


def _ensure(spark, path: str) -> None:
    """An empty set of replies where there is none."""
    spark.createDataFrame([], WRITTEN).write.mode("append").parquet(path)


def _with_answers(answered: DataFrame, df: DataFrame, *first: str, more: Sequence[str] = ()) -> DataFrame:
    """The columns of ``df``, some of the request, and ``reply`` with its texts cut at the stop marker of the row."""
    cut = F.expr("transform(_texts, t -> CASE WHEN stop = '' THEN t ELSE substring_index(t, stop, 1) END)")
    own = (*first, "reply", "answers", "answer", *more)
    kept = [c for c in df.columns if c not in own]
    answered = answered.withColumn("_texts", text.reply_texts("reply")).withColumn("answers", cut)
    return answered.select(*kept, *first, "reply", "answers", F.get("answers", F.lit(0)).alias("answer"), *more)


def generate(
    df: DataFrame,
    load: Callable[[], Generator] = echo_generator,
    instruction: str = "prompt",
    style: str = "serving",
    model: str | None = None,
) -> DataFrame:
    """``df`` with the raw ``reply``, its ``answer`` and all its ``answers``, each cut at the row's stop marker.

    ``answer`` is the first of ``answers``, of which there are as many as the reply has candidates.  ``load`` runs once per
    worker process where the caller names the ``model`` (one name, one model), else once per task; its result maps a list
    of requests to as many replies in JSON.  Rows with a null prompt get a null reply without being sent.
    """

    @F.arrow_udf("string")
    def ask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        generator = workers.kept(model, load)
        for batch in batches:
            rows = batch.to_pylist()
            sent = [r for r in rows if r["prompt"] is not None]
            replies = iter(workers.as_many(sent, generator(sent), "replies"))
            yield pa.array([None if r["prompt"] is None else next(replies) for r in rows], pa.string())

    ready = requests(df, instruction, style)
    request = F.struct(
        F.col("request").alias("prompt"), "temperature", "max_tokens", "stop", "candidate_count"
    )
    answered = ready.withColumn("reply", ask(request))
    return _with_answers(answered, df, "request")
