"""Sums of token weights by a model that is too large to broadcast.

Texts are dealt to parts by a hash of their keys. Each part asks once for every
distinct token it has, so what meets the model are these and not the tokens of
all texts: a frequent word is one row per part. The weights found go back to
their part, where the texts look them up in Arrow batches; texts move once, and
sums are one row per text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART = "_part"
_WORDS = "_words"
# Parts the words of a packed text.
_BREAK = "\x00"
# Most (model, token) pairs of a batch that are counted off in a table.
_MOST_CODES = 8_000_000


def pack(words: Column) -> Column:
    """An array of words as one string, which is shuffled in half the bytes. An
    empty one, or one with a null or the break in a word, stays an array."""
    joined = F.array_join(words, _BREAK, _BREAK)
    breaks = F.octet_length(joined) - F.octet_length(F.replace(joined, F.lit(_BREAK), F.lit("")))
    plain = (F.size(words) > 0) & (breaks == F.size(words) - 1)
    return F.struct(F.when(plain, joined).alias("text"), F.when(~plain, words).alias("words"))


def _words_of(texts: pa.Table) -> list[tuple[pa.RecordBatch, pa.ListArray]]:
    """The texts in batches, each with its lists of words."""
    out = []
    for batch in texts.to_batches():
        packed = batch.column(batch.schema.names.index(_WORDS))
        # A text that no model is to see has no words at all.
        is_text = pc.is_valid(pc.struct_field(packed, "text"))
        for wanted, name in ((is_text, "text"), (pc.invert(is_text), "words")):
            part = batch.filter(wanted)
            if part.num_rows:
                words = pc.struct_field(part.column(part.schema.names.index(_WORDS)), name)
                out.append((part, pc.split_pattern(words, _BREAK) if name == "text" else words))
    return out


def _codes(batch: pa.RecordBatch, words: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """For each token of the batch's texts, nulls left out, its text's place in the
    batch and the number of its (model, token) pair, negative without a model; then the
    batch's models and its distinct tokens, which the numbers count row by row."""
    flat = words.flatten()
    coded = flat.dictionary_encode()
    models = batch.column(batch.schema.names.index("model")).dictionary_encode()
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(batch.num_rows), lengths)
    token = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
    if flat.null_count:
        text, token = text[token >= 0], token[token >= 0]
    model = pc.fill_null(models.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    code = (model * len(coded.dictionary))[text] + token
    return text, code, models.dictionary, coded.dictionary


def _for_each(code: np.ndarray, size: int, find: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``find(code)``, asked once for each distinct code below ``size`` unless
    these are too many for a table."""
    if size > _MOST_CODES:
        return find(code)
    seen = _seen(code, size)
    table = np.zeros(size, np.int64)
    table[seen] = find(seen)
    return table[code]


def _seen(code: np.ndarray, size: int) -> np.ndarray:
    """The distinct codes, in order."""
    if size > _MOST_CODES:
        return np.unique(code)
    flags = np.zeros(size, bool)
    flags[code] = True
    return np.flatnonzero(flags)


def _distinct(values: Sequence[pa.Array], kind: pa.DataType) -> pa.Array:
    found = pc.unique(pa.chunked_array([pc.unique(v) for v in values], kind))
    return found.drop_null()


def _wanted(texts: pa.Table) -> pa.Table:
    """The distinct (model, token) pairs of a part."""
    pairs = []
    for batch, words in _words_of(texts):
        _, code, models, tokens = _codes(batch, words)
        model, token = np.divmod(_seen(code[code >= 0], len(models) * len(tokens)), max(1, len(tokens)))
        pairs.append(pa.table({"model": models.take(pa.array(model)), "token": tokens.take(pa.array(token))}))
    found = pairs[0] if len(pairs) == 1 else pa.concat_tables(pairs).group_by(["model", "token"]).aggregate([])
    part = np.full(found.num_rows, texts.column(_PART)[0].as_py(), np.int32)
    return pa.table({_PART: pa.array(part), "model": found.column("model"), "token": found.column("token")})


def _summing(keys: Sequence[str], slots: int):
    """A part's texts and weights to one row of sums per text."""

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        models = _distinct(found.column("model").chunks, pa.string())
        tokens = _distinct(found.column("token").chunks, pa.string())
        at = pc.index_in(found.column("model"), value_set=models).to_numpy().astype(np.int64) * len(tokens)
        at = at + pc.index_in(found.column("token"), value_set=tokens).to_numpy()
        order = np.argsort(at)
        at = at[order]
        weights = [found.column(f"w{i}").to_numpy()[order] for i in range(slots)]  # null as NaN
        known = [~np.isnan(w) for w in weights]
        out = []
        for batch, words in _words_of(texts):
            text, code, own_models, own_tokens = _codes(batch, words)
            n, width = batch.num_rows, max(1, len(own_tokens))
            model_at, token_at = (
                pc.fill_null(pc.index_in(own, value_set=all_), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                for own, all_ in ((own_models, models), (own_tokens, tokens))
            )

            def find(codes: np.ndarray) -> np.ndarray:
                """The places of pairs among the weights, -1 if there is none."""
                model, token = model_at[codes // width], token_at[codes % width]
                pair = np.where((model >= 0) & (token >= 0), model * len(tokens) + token, -1)
                place = np.searchsorted(at, pair)
                place[place == len(at)] = -1
                place[place >= 0] = np.where(at[place[place >= 0]] == pair[place >= 0], place[place >= 0], -1)
                return place

            modelled = code >= 0
            of, place = text[modelled], _for_each(code[modelled], len(own_models) * len(own_tokens), find)
            of, place = of[place >= 0], place[place >= 0]
            sums, first, every = [], None, np.bincount(of, minlength=n)
            for weight, there in zip(weights, known):
                if there.all():
                    count, total = every, np.bincount(of, weight[place], minlength=n)
                else:
                    some = there[place]
                    count = np.bincount(of[some], minlength=n)
                    total = np.bincount(of[some], weight[place[some]], minlength=n)
                first = count if first is None else first
                sums.append(pa.array(total, pa.float64(), mask=count == 0))
            columns = [batch.column(batch.schema.names.index(c)) for c in (*keys, "model")]
            counts = [pa.array(np.bincount(text, minlength=n), pa.int64()), pa.array(first, pa.int64())]
            out.append(pa.table([*columns, *counts, *sums], names=[*keys, "model", "_tokens", "_known", *(f"m{i}" for i in range(slots))]))
        return pa.concat_tables(out)

    return run


def sums_by_part(df: DataFrame, keys: Sequence[str], weights: DataFrame, slots: int) -> DataFrame:
    """``(keys, model, _tokens, _known, m0 ..)`` of ``df (keys, model, _words)``, the
    words packed: a text's tokens, those among them that its model knows, and the sums of their
    weights. Rows equal in all keys and the model give one."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    texts = df.select(part.alias(_PART), *keys, "model", _WORDS).repartition(n, _PART)
    kinds = {f.name: f for f in texts.schema.fields}
    wanted = texts.groupBy(_PART).applyInArrow(_wanted, T.StructType([kinds[_PART], T.StructField("model", T.StringType()), T.StructField("token", T.StringType())]))
    found = wanted.join(weights, ["model", "token"]).select(_PART, "model", "token", *[f"w{i}" for i in range(slots)])
    shown = T.StructType(
        [kinds[c] for c in (*keys, "model")]
        + [T.StructField(c, T.LongType()) for c in ("_tokens", "_known")]
        + [T.StructField(f"m{i}", T.DoubleType()) for i in range(slots)]
    )
    sums = texts.groupBy(_PART).cogroup(found.groupBy(_PART)).applyInArrow(_summing(keys, slots), shown)
    return sums.groupBy(*keys, "model").agg(*[F.sum(f.name).alias(f.name) for f in shown.fields[len(keys) + 1 :]])
