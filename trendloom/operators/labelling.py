"""Labels for the residue: an outside labeller given by the caller, or a trained text model."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.functions.text import normalize_genre, sanitize_keyword
from trendloom.schemas import GENRES, UNKNOWN
from trendloom.session import stage
from trendloom.sources.sinks import resolve_version, update_version

# Functions of this module travel with the task, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Provider = Callable[[list[str]], str]

_GROUP = "originals ARRAY<STRING>, asked ARRAY<STRING>"
_ASK = f"{_GROUP}, response STRING, error STRING"


def in_groups(keywords: DataFrame, batch: int = 50) -> DataFrame:
    """(originals, asked): the keywords as they are and as they are put, in groups of ``batch``.

    Groups are formed within each task's rows. Keywords that are empty once cleaned are left out. Those that become equal all
    stay, each beside what it is put as; :func:`ask_groups` puts it once.
    """

    def group(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame[["keyword_norm", "asked"]]
            parts = (frame.iloc[start : start + batch] for start in range(0, len(frame), batch))
            parts = [part for part in (p[p["asked"] != ""] for p in parts) if not part.empty]
            if parts:
                yield pd.DataFrame({"originals": [p["keyword_norm"].tolist() for p in parts], "asked": [p["asked"].tolist() for p in parts]})

    sent = keywords.select("keyword_norm", sanitize_keyword(F.col("keyword_norm")).alias("asked"))
    return sent.mapInPandas(group, _GROUP)


def ask_groups(groups: DataFrame, provider: Provider, stop_after: int | None = None) -> DataFrame:
    """One row for each group with its raw answer, or with the error of a failing call.

    After ``stop_after`` failures in a row a task puts no further groups, as the provider is hardly there; they have no row.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failures = 0
        for frame in frames:
            for originals, asked in zip(frame["originals"], frame["asked"]):
                if stop_after is not None and failures >= stop_after:
                    continue
                answer = error = None
                try:
                    answer = provider(list(dict.fromkeys(asked)))
                except Exception as trouble:  # whatever an outside service may do
                    error = f"{type(trouble).__name__}: {trouble}"
                failures = failures + 1 if error else 0
                yield pd.DataFrame({"originals": [list(originals)], "asked": [list(asked)], "response": [answer], "error": [error]})

    return groups.mapInPandas(ask, _ASK)


def ask_in_batches(keywords: DataFrame, provider: Provider, batch: int = 50) -> DataFrame:
    """Send keywords to ``provider`` in groups of ``batch``; one row per group with its raw answer or error.

    A failing call leaves a null answer, so only its own group goes without labels.
    """
    return ask_groups(in_groups(keywords, batch), provider)


def _answer_object(response: Column) -> Column:
    """The JSON object in an answer, from its first to its last brace, whatever stands around it; null if it is none."""
    return F.from_json(F.regexp_extract(response, r"(?s)\{.*\}", 0), "map<string,string>")


def parse_answers(answers: DataFrame) -> DataFrame:
    """(keyword_norm, genre) from raw answers.

    An answer is a JSON object keyword → genre, perhaps with other text around it. If more than half of its
    keys are genre codes it was written the wrong way round and is turned. Keys are mapped back
    to the keywords as they were before cleaning; keys never asked for are dropped.
    """
    entries = F.map_entries(_answer_object(F.col("response")))
    each = (
        answers.withColumn("entries", entries)
        .withColumn("codes", F.size(F.filter("entries", lambda e: F.upper(e["key"]).isin(*GENRES))))
        .withColumn("turned", F.col("codes") > F.size("entries") * 0.5)
        .select("originals", "asked", "turned", F.posexplode("entries").alias("pos", "e"))
    )
    key = F.when(F.col("turned"), F.col("e.value")).otherwise(F.col("e.key"))
    value = F.when(F.col("turned"), F.col("e.key")).otherwise(F.col("e.value"))
    # Several keywords may have been put as one.
    meant = F.transform(F.filter(F.arrays_zip("asked", "originals"), lambda z: z["asked"] == F.col("key")), lambda z: z["originals"])
    return (
        each.select("originals", "asked", "pos", key.alias("key"), normalize_genre(value).alias("genre"))
        .where(F.col("key").isNotNull())
        .withColumn("meant", meant)
        .withColumn("keyword_norm", F.explode(F.when(F.size("meant") > 0, F.col("meant")).otherwise(F.array("key"))))
        .where(F.array_contains("originals", F.col("keyword_norm")))
        .groupBy("keyword_norm")
        .agg(F.max_by("genre", "pos").alias("genre"))
    )


def label_residual(keywords: DataFrame, provider: Provider, batch: int = 50, keep_unknown: bool = False) -> DataFrame:
    """(keyword_norm, genre) labels from ``provider``; UNKNOWN answers are kept only on request."""
    labels = parse_answers(ask_in_batches(keywords, provider, batch))
    return labels if keep_unknown else labels.where(F.col("genre") != UNKNOWN)


class AnswerLedger:
    """What a provider was asked and what became of it, one row for each group of keywords, as numbered versions under ``root``.

    A group that failed, by an error or an answer that is no JSON object, is put again as it was, until it has been put ``most_tries`` times.
    Keywords of any group in the ledger are not put anew, so an interrupted or repeated run asks only what is open. The
    ledger is written when the calls of a run are done; a run that dies before may put its groups again. Two runs at once
    lose no outcome.
    """

    SCHEMA = f"group_id STRING, {_ASK}, tries INT"

    def __init__(self, spark: SparkSession, root: str, batch: int = 50, most_tries: int = 3, stop_after: int | None = 5):
        self.spark, self.root, self.batch, self.most_tries, self.stop_after = spark, root, batch, most_tries, stop_after

    def _version(self, path: str | None) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(path) if path else self.spark.createDataFrame([], self.SCHEMA)

    def read(self) -> DataFrame:
        return self._version(resolve_version(self.spark, self.root))

    def open_groups(self) -> DataFrame:
        """Groups that failed and may be put again."""
        return self.read().where(F.col("error").isNotNull() & (F.col("tries") < self.most_tries))

    def run(self, keywords: DataFrame, provider: Provider) -> DataFrame:
        """Put what is open and the keywords that are new; returns the outcomes of this run."""
        held = self.read().select(F.explode("originals").alias("keyword_norm"))
        new = keywords.select("keyword_norm").distinct().join(held, "keyword_norm", "left_anti")
        groups = stage(in_groups(new, self.batch).unionByName(self.open_groups().select("originals", "asked")), "asked-groups")
        answers = ask_groups(groups, provider, self.stop_after)
        wrong = F.col("error").isNull() & _answer_object(F.col("response")).isNull()
        outcomes = answers.withColumns({
            "error": F.when(wrong, F.concat(F.lit("no JSON object: "), F.coalesce(F.left("response", F.lit(200)), F.lit("null")))).otherwise(F.col("error")),
            "group_id": F.sha2(F.array_join(F.array_sort("asked"), "\n"), 256),
            "tries": F.lit(1),
        })
        names = [f.partition(" ")[0] for f in self.SCHEMA.split(", ")]
        outcomes = stage(outcomes.select(*names), "outcomes")

        def merged(path: str | None) -> DataFrame:
            both = self._version(path).withColumn("new", F.lit(0)).unionByName(outcomes.withColumn("new", F.lit(1)))
            # An answer holds against an error; of two of a kind the newer one does.
            newest = F.max_by(F.struct("originals", "asked", "response", "error"), F.struct(F.col("error").isNull(), "new"))
            rows = both.groupBy("group_id").agg(newest.alias("o"), F.sum("tries").cast("int").alias("tries"))
            return rows.select("group_id", "o.*", "tries").select(*names)

        update_version(self.spark, self.root, merged)
        return outcomes

    def labels(self, keep_unknown: bool = False) -> DataFrame:
        """(keyword_norm, genre) of all answers so far."""
        labels = parse_answers(self.read().where(F.col("error").isNull()))
        return labels if keep_unknown else labels.where(F.col("genre") != UNKNOWN)


def train_ml_labeller(labelled: DataFrame, features: int = 1 << 14, max_iter: int = 20):
    """Word and word-pair logistic regression over (kw, genre) rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, SQLTransformer, StringIndexer, Tokenizer

    pairs = (
        "SELECT *, concat(words, transform(sequence(1, greatest(size(words) - 1, 1)), "
        "i -> concat_ws(' ', slice(words, i, 2)))) AS terms FROM __THIS__"
    )
    return Pipeline(
        stages=[
            StringIndexer(inputCol="genre", outputCol="label", stringOrderType="alphabetAsc"),
            Tokenizer(inputCol="kw", outputCol="words"),
            SQLTransformer(statement=pairs),
            HashingTF(inputCol="terms", outputCol="features", numFeatures=features),
            LogisticRegression(maxIter=max_iter, regParam=0.001),
        ]
    ).fit(labelled.select("kw", "genre"))


def ml_label(keywords: DataFrame, model, threshold: float = 0.65) -> DataFrame:
    """(kw, genre): the model's genre where its probability reaches ``threshold``, else UNKNOWN."""
    from pyspark.ml.functions import vector_to_array

    names = F.array(*[F.lit(g) for g in model.stages[0].labels])
    scored = keywords.select("kw")
    for step in model.stages[1:]:
        scored = step.transform(scored)
    probability = F.array_max(vector_to_array("probability"))
    genre = F.element_at(names, F.col("prediction").cast("int") + 1)
    return scored.select("kw", F.when(probability >= threshold, genre).otherwise(F.lit(UNKNOWN)).alias("genre"))
