"""Topic labels from linear models held as tables of weights.

A model is rows of ``(model, token, label, weight)``. A text's logit for a
label is the mean of the weights of its known tokens plus the label's bias (the
row with an empty token); probabilities are the softmax of the logits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift import fixed
from pagesift.functions.hashing import let
from pagesift.operators.lookup import fits
from pagesift.operators.parts import pack, sums_by_part
from pagesift.operators.words import token_rows
from pagesift.session import stage

# Labels whose probabilities agree to this many places are ordered by name.
TIE_PLACES = 6
# Most weights of a model that is sent to every executor: rows of a token and
# eight numbers, several hundred bytes each once hashed.
MAX_BROADCAST_WEIGHTS = 100_000
_ROW = "_row"


@dataclass(frozen=True)
class TopicModel:
    """Weights with one row per token, ready to be joined to tokens.

    ``weights``: model, token and one column ``w{i}`` per label slot.
    ``heads``: per model the array of its (label, bias) pairs by slot.
    """

    weights: DataFrame
    heads: DataFrame
    slots: int
    small: bool
    small_heads: bool


@dataclass(frozen=True)
class Plugin:
    """A user's own Python model: ``load()`` makes it, ``score(model, words)``,
    or ``score(model, words, parent)`` for children, gives a label with its
    probability, or None for no answer."""

    load: Callable[[], object]
    score: Callable[..., tuple[str, float] | None]


def topic_model(model: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_WEIGHTS) -> TopicModel:
    """Prepare a model table, reading it twice: pass one that is stored.

    The prepared weights are stored too, since every scoring reads them.

    Turning labels into columns lets each text token be one row through the
    join and the sums, however many labels there are. Labels get their slots
    per model, so models with different labels share the columns.
    """
    model = model.withColumn("label", F.replace("label", F.lit(fixed.LABEL_PREFIX), F.lit("")))
    bias = F.max(F.when(F.col("token") == "", F.col("weight")))
    labels = model.groupBy("model", "label").agg(F.coalesce(bias, F.lit(0.0)).alias("bias"))
    # One row per model; its labels are slots in the order of their names.
    head = F.array_sort(F.collect_list(F.struct("label", "bias")))
    heads = stage(labels.groupBy("model").agg(head.alias("head")), "heads")
    small_heads = max_broadcast_rows > 0 and fits(heads, max_broadcast_rows)
    slots = heads.agg(F.max(F.size("head"))).first()[0] or 1
    slot_of = heads.select("model", F.posexplode("head").alias("slot", "_h")).select("model", F.col("_h.label").alias("label"), "slot")
    with_slot = model.where(F.col("token") != "").join(F.broadcast(slot_of) if small_heads else slot_of, ["model", "label"])
    weights = stage(
        with_slot.groupBy("model", "token")
        .agg(*[F.sum(F.when(F.col("slot") == i, F.col("weight")).otherwise(0.0)).alias(f"w{i}") for i in range(slots)]),
        "weights",
    )
    # Wide rows count by their weights, so the bound is one of bytes.
    small = max_broadcast_rows > 0 and fits(weights, max(1, max_broadcast_rows // max(1, slots // 8)))
    return TopicModel(weights, heads, slots, small, small_heads)


def _root_head(model: TopicModel) -> Column:
    """The (label, bias) array of the one model that all texts share."""
    root = model.heads.where(F.col("model") == fixed.ROOT_MODEL).first()
    if root is None:
        return F.lit(None).cast("array<struct<label:string,bias:double>>")
    return F.array(*[F.struct(F.lit(h.label).alias("label"), F.lit(h.bias).alias("bias")) for h in root["head"]])


def _best_label(head: Column, slots: int) -> Column:
    """Struct of the best label and its probability, from the sums ``m{i}``
    over ``_known`` tokens."""
    sums = F.array(*[F.col(f"m{i}") for i in range(slots)])
    logits = F.transform(
        head, lambda h, i: F.struct(h["label"].alias("label"), (F.get(sums, i) / F.col("_known") + h["bias"]).alias("z"))
    )

    def soften(scored: Column) -> Column:
        # exp is taken relative to the largest logit, which keeps it in range.
        top = F.array_max(F.transform(scored, lambda s: s["z"]))
        return F.transform(scored, lambda s: F.struct(s["label"].alias("label"), F.exp(s["z"] - top).alias("p")))

    def choose(powers: Column) -> Column:
        total = F.aggregate(powers, F.lit(0.0), lambda acc, s: acc + s["p"])
        ranked = F.transform(
            powers,
            lambda s: F.struct(
                (-F.round(s["p"] / total, TIE_PLACES)).alias("key"), s["label"].alias("label"), (s["p"] / total).alias("p")
            ),
        )
        return F.array_min(ranked)

    return let(let(logits, soften), choose)


def score_labels(
    df: DataFrame,
    model: TopicModel,
    ids: Sequence[str] = ("fid",),
    tokens: str = "tokens",
    key: str | None = None,
    keep_row: bool = False,
) -> DataFrame:
    """Best label of each text: ``(ids, [key], label, prob)``.

    ``tokens`` is an array of words or a string of words parted by spaces. All
    texts use the root model, or with ``key`` the model named in that column.
    Blank texts get (unknown, -1); texts without a known token (unknown, -3) for
    the root model and (<model>_other, -4) for others. Rows that share their ids
    but not their tokens are kept apart, and equal rows give one. With a broadcast model the tokens of a text never leave their
    task: what is shuffled is one row of sums per text, and not even that if
    ``df`` is already partitioned by ``ids``. With a larger one texts move once
    and only distinct tokens meet the weights (``parts``); sums are stored.
    """
    ids = list(ids)
    words = F.col(tokens)
    if isinstance(df.schema[tokens].dataType, T.StringType):
        words = F.filter(F.split(words, r"[\x00-\x20]+"), lambda w: w != "")
    which = F.col(key) if key else F.lit(fixed.ROOT_MODEL)
    keys = [*ids, _ROW]
    df = df if _ROW in df.columns else df.withColumn(_ROW, F.xxhash64(tokens))
    if model.small:
        rows = token_rows(df, [*keys, which.alias("model")], words)
        found = rows.join(F.broadcast(model.weights), ["model", "token"], "left")
        sums = found.groupBy(*keys, "model").agg(
            F.count("token").alias("_tokens"),
            F.count("w0").alias("_known"),
            *[F.sum(f"w{i}").alias(f"m{i}") for i in range(model.slots)],
        )
    else:
        # Stored, since what follows reads the labels more than once.
        packed = words if isinstance(df.schema[tokens].dataType, T.StructType) else pack(words)
        texts = df.select(*keys, which.alias("model"), packed.alias("_words"))
        sums = stage(sums_by_part(texts, keys, model.weights, model.slots), "sums")
    if key:
        sums = sums.join(F.broadcast(model.heads) if model.small_heads else model.heads, "model", "left")
        head = F.col("head")
    else:
        head = _root_head(model)
    blank = F.col("_tokens") == 0
    unknown = (F.col("_known") == 0) | head.isNull()
    best = _best_label(head, model.slots)
    if key:
        is_root = F.col("model") == fixed.ROOT_MODEL
        other = F.concat("model", F.lit(fixed.OTHER_SUFFIX))
        no_answer = F.when(is_root, F.lit(fixed.UNKNOWN)).otherwise(other)
        code = F.when(is_root, F.lit(fixed.NO_ANSWER_ROOT)).otherwise(F.lit(fixed.NO_ANSWER_CHILD))
    else:
        no_answer, code = F.lit(fixed.UNKNOWN), F.lit(fixed.NO_ANSWER_ROOT)

    def answer(label: Column, prob: Column) -> Column:
        return F.struct(label.alias("label"), prob.alias("prob"))

    chosen = (
        F.when(blank, answer(F.lit(fixed.UNKNOWN), F.lit(fixed.BLANK_TEXT)))
        .when(unknown, answer(no_answer, code))
        .otherwise(let(best, lambda b: answer(b["label"], b["p"])))
    )
    named_key = [F.col("model").alias(key)] if key else []
    shown = keys if keep_row else ids
    return sums.select(*shown, *named_key, chosen.alias("_a")).select(*shown, *([key] if key else []), "_a.label", "_a.prob")


def score_label_only(
    df: DataFrame, model: TopicModel, ids: Sequence[str] = ("fid",), tokens: str = "tokens", key: str | None = None
) -> DataFrame:
    """The labels without their probabilities."""
    return score_labels(df, model, ids, tokens, key).select(*ids, "label")


def score_with(
    df: DataFrame,
    load: Callable[[], object],
    score: Callable[..., tuple[str, float] | None],
    ids: Sequence[str] = ("fid",),
    words: str = "words",
    parent: str | None = None,
) -> DataFrame:
    """Score texts with a user's own Python model: ``(ids, words, [parent], label, prob)``.

    The model is loaded once per partition. A null or blank text gets (unknown,
    -1) without being shown to it; no answer gives (unknown, -3), or with a
    ``parent`` column (<parent>_other, -4); a text on which ``score`` fails gets
    (unknown, -255), and the job goes on.
    """
    failed = (fixed.UNKNOWN, fixed.SCORER_FAILED)
    blank = (fixed.UNKNOWN, fixed.BLANK_TEXT)

    def answer(model: object, text: str | None, above: str | None) -> tuple[str, float]:
        if text is None or not text.strip():
            return blank
        try:
            found = score(model, text) if parent is None else score(model, text, above)
            if found is not None:
                return str(found[0]), float(found[1])
        except Exception:
            return failed
        if parent is None:
            return fixed.UNKNOWN, fixed.NO_ANSWER_ROOT
        return f"{above}{fixed.OTHER_SUFFIX}", fixed.NO_ANSWER_CHILD

    columns = [*ids, words, *([parent] if parent else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = None
        for batch in batches:
            if loaded is None:
                loaded = (load(),)
            above = batch.column(parent).to_pylist() if parent else [None] * batch.num_rows
            made = [answer(loaded[0], text, p) for text, p in zip(batch.column(words).to_pylist(), above)]
            labels, probs = ([a[k] for a in made] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels, pa.string()), pa.array(probs, pa.float64())], names=[*columns, "label", "prob"]
            )

    given = df.select(*columns)
    schema = T.StructType([*given.schema.fields, T.StructField("label", T.StringType()), T.StructField("prob", T.DoubleType())])
    return given.mapInArrow(run, schema)


def _spread(texts: DataFrame, ids: Sequence[str], *models: TopicModel) -> DataFrame:
    """Texts by their ids, which scoring by broadcast models keeps; larger models
    deal the texts out themselves."""
    return texts.repartition(*ids, _ROW) if all(m.small for m in models) else texts


def parent_labels(
    words: DataFrame, model: TopicModel | Plugin, ids: Sequence[str] = ("fid",), column: str = "words"
) -> DataFrame:
    """``(ids, words, cat, prob)`` by the root model.

    Texts are spread by ``ids`` once; scoring by a broadcast model and the join
    back both keep that.
    A user's own model scores them where they are.
    """
    if isinstance(model, Plugin):
        scored = score_with(words, model.load, model.score, ids, column)
        return scored.select(*ids, column, F.col("label").alias("cat"), "prob")
    spread = _spread(words.select(*ids, column, F.xxhash64(column).alias(_ROW)), ids, model)
    scores = score_labels(spread, model, ids, column, keep_row=True).withColumnRenamed("label", "cat")
    return spread.join(scores, [*ids, _ROW]).select(*ids, column, "cat", "prob")


def child_labels(
    parents: DataFrame,
    models: TopicModel | Plugin,
    listed: Sequence[str] = fixed.PARENT_TOPICS,
    ids: Sequence[str] = ("fid",),
    column: str = "words",
    keep_words: bool = True,
) -> DataFrame:
    """Texts of the listed parents, each scored by its parent's own model:
    ``(ids, words, cat, prob)``, or without the words and the join for them.

    One pass over all parents, with the parent in the join key. Other texts,
    those labelled unknown among them, give no row.
    """
    chosen = parents.where(F.col("cat").isin(*listed)).select(*ids, column, F.col("cat").alias("_parent"))
    if isinstance(models, Plugin):
        scored = score_with(chosen, models.load, models.score, ids, column, "_parent")
        return scored.select(*ids, *([column] if keep_words else []), F.col("label").alias("cat"), "prob")
    chosen = chosen.withColumn(_ROW, F.xxhash64(column))
    scores = score_labels(chosen, models, ids, column, key="_parent", keep_row=True).withColumnRenamed("label", "cat").drop("_parent")
    if not keep_words:
        return scores.drop(_ROW)
    return chosen.drop("_parent").join(scores, [*ids, _ROW]).select(*ids, column, "cat", "prob")


def two_level_labels(
    tokens: DataFrame,
    parent: TopicModel,
    children: TopicModel,
    listed: Sequence[str],
    ids: Sequence[str],
    column: str,
    prefix: str,
) -> DataFrame:
    """Parent and child label of each text in one row:
    ``(ids, {prefix}_pcat, {prefix}_pprob, {prefix}_ccat, {prefix}_cprob)``.

    With broadcast models the words are spread by ``ids`` once: parent scores, the
    join that gives each text its parent's model, and child scores all keep that.
    """
    pcat, pprob, ccat, cprob = (f"{prefix}_{name}" for name in ("pcat", "pprob", "ccat", "cprob"))
    spread = _spread(tokens.select(*ids, column, F.xxhash64(column).alias(_ROW)), ids, parent, children)
    if not parent.small and not children.small and isinstance(tokens.schema[column].dataType, T.ArrayType):
        spread = spread.withColumn(column, pack(F.col(column)))
    above = score_labels(spread, parent, ids, column, keep_row=True).select(
        *ids, _ROW, F.col("label").alias(pcat), F.col("prob").alias(pprob)
    )
    below = F.when(F.col(pcat).isin(*listed), F.col(pcat))
    named = spread.join(above, [*ids, _ROW]).withColumn("_model", below)
    # Words that no child model will see are not unrolled.
    named = named.withColumn(column, F.when(F.col("_model").isNotNull(), F.col(column)))
    scored = score_labels(named, children, [*ids, pcat, pprob], column, key="_model")
    has_child = F.col("_model").isNotNull()
    return scored.select(
        *ids, pcat, pprob, F.when(has_child, F.col("label")).alias(ccat), F.when(has_child, F.col("prob")).alias(cprob)
    )


def union_labels(*parts: DataFrame) -> DataFrame:
    """All rows of several label tables, repeats kept."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
