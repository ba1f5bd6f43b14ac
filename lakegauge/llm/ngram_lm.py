"""Scores of texts under a word bigram model by deleted interpolation.

The probability of a word after another mixes the maximum-likelihood estimates of the bigram and of
the word alone with the uniform one. The weights depend on how often the word before was seen, by
powers of two, and are learned by expectation-maximisation on a part of the training texts, with counts from
which that part is deleted; the scores then use the counts of all training texts.

Counting goes by blocks of documents. A block asks for each different word and bigram it holds once,
however often it has it; requests meet, ordered by hash, in as many groups as there are blocks, are
added up, and the answers go back to the blocks. So the most frequent word of the corpus is one
request per block. All counts of words and bigrams are kept, none is cut off.

Edge cases: a null or empty text is its end mark alone; without training texts every token has
probability one; a null key counts as the empty string when rows are dealt to training and held-out;
repeated rows are counted and scored one by one; an empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StructField, StructType

from lakegauge.llm.columns import stored
from lakegauge.llm.packed import pack_integers, pack_sorted, unpack_integers, unpack_sorted
from lakegauge.llm.textscan import mixed, scan, text_slices, word_hashes

FOLDS, TEST_FOLD, DELETED_FOLD = 7, 2, 3
BLOCK_BYTES = 12 << 20
ROUNDS = 60

#: Steps of a doubling by which probabilities are told apart when the weights are learned.
_STEPS = 4
_END = np.uint64(0x0E0D0E0D0E0D0E0D)
_PAIR = np.uint64(0xD1342543DE82EF95)
_WORDS, _BIGRAMS = 0, 1


def fold(key: str = "doc_id") -> Column:
    """Remainder by which a row is for training or not: crc32 of its key as text."""
    return (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % FOLDS).cast("int")


# --- blocks -------------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """Tokens of a block's documents as numbers into its sorted vocabulary of hashes."""

    vocabulary: np.ndarray
    tokens: np.ndarray
    sizes: np.ndarray
    folds: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, folds: np.ndarray) -> Block:
        pieces, sizes = [], []
        for start, end in text_slices(texts):
            words = scan(texts.slice(start, end - start))
            pieces.append(np.insert(word_hashes(words), words.first[1:], _END))
            sizes.append(words.counts + 1)
        vocabulary, tokens = np.unique(np.concatenate(pieces), return_inverse=True)
        return cls(vocabulary, tokens, np.concatenate(sizes), folds)

    def per_token(self, per_text: np.ndarray) -> np.ndarray:
        return np.repeat(per_text, self.sizes)

    def before(self) -> np.ndarray:
        """The token before each one; before a text's first stands the end mark."""
        result = np.empty_like(self.tokens)
        result[1:] = self.tokens[:-1]
        result[:1] = np.searchsorted(self.vocabulary, _END)
        return result

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the different bigrams, and the number of that of each token with the one before."""
        pairs = (self.before().astype(np.uint64) << np.uint64(32)) | self.tokens.astype(np.uint64)
        different, which = np.unique(pairs, return_inverse=True)
        first = self.vocabulary[(different >> np.uint64(32)).astype(np.int64)]
        second = self.vocabulary[(different & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        hashes = mixed(first * _PAIR + second)
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return hashes[order], rank[which]

    def requests(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Kind, sorted hashes, and how often the training texts and their deleted part have each."""
        folds = self.per_token(self.folds)
        hashes, which = self.bigrams()
        for kind, keys, at in ((_WORDS, self.vocabulary, self.tokens), (_BIGRAMS, hashes, which)):
            train = np.bincount(at[folds != TEST_FOLD], minlength=len(keys))
            deleted = np.bincount(at[folds == DELETED_FOLD], minlength=len(keys))
            yield kind, keys, train, deleted


def _block_rows(documents: DataFrame, key: str, text: str, block_bytes: int) -> DataFrame:
    """A row per block; the documents of the deleted part have blocks of their own."""
    rows = documents.select(F.col(key).alias("key"), fold(key).alias("fold"), F.col(text).alias("text"))
    keys = StructField("keys", ArrayType(rows.schema["key"].dataType))
    ddl = "block long, deleted boolean, folds binary, sizes binary, vocabulary binary, tokens binary"
    schema = StructType([*StructType.fromDDL(ddl).fields, keys])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[bool, list[pa.RecordBatch]] = {False: [], True: []}

        def block(deleted: bool) -> pa.RecordBatch:
            nonlocal number
            table = pa.Table.from_batches(waiting[deleted]).combine_chunks()
            waiting[deleted] = []
            folds = table["fold"].to_numpy().astype(np.uint64)
            made = Block.of(table["text"].combine_chunks(), folds)
            # Frequent words get small numbers, which leaves most planes of the tokens empty.
            parts = (made.folds, made.sizes, None, made.tokens)
            folded, sizes, _, tokens = (None if p is None else pack_integers(p) for p in parts)
            row = {"block": [number], "deleted": [deleted], "folds": [folded], "sizes": [sizes]}
            row |= {"vocabulary": [pack_sorted(made.vocabulary)], "tokens": [tokens]}
            number += 1
            arrays = [pa.array(v) for v in row.values()]
            key_list = table["key"].combine_chunks()
            arrays.append(pa.ListArray.from_arrays(pa.array([0, len(key_list)], pa.int32()), key_list))
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        held = {False: 0, True: 0}
        for batch in batches:
            for start, end in text_slices(batch.column("text"), max(1, block_bytes // 4)):
                part = batch.slice(start, end - start)
                is_deleted = part.column("fold").to_numpy() == DELETED_FOLD
                for deleted in (False, True):
                    chosen = part.filter(pa.array(is_deleted == deleted))
                    if not len(chosen):
                        continue
                    waiting[deleted].append(chosen)
                    held[deleted] += chosen.column("text").nbytes
                    if held[deleted] >= block_bytes:
                        yield block(deleted)
                        held[deleted] = 0
        for deleted in (False, True):
            if waiting[deleted]:
                yield block(deleted)

    return rows.mapInArrow(gather, schema)


def _read_block(row: dict) -> Block:
    folds, sizes = unpack_integers(row["folds"]), unpack_integers(row["sizes"]).astype(np.int64)
    tokens = unpack_integers(row["tokens"]).astype(np.int64)
    return Block(unpack_sorted(row["vocabulary"]), tokens, sizes, folds)


# --- counts -------------------------------------------------------------------


def _requests(blocks: DataFrame, groups: int) -> DataFrame:
    """Requests by group of hashes: ``bucket, kind, block, hashes, train, deleted``."""
    shift = np.uint64(64 - max(1, (groups - 1).bit_length()))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for kind, hashes, train, deleted in _read_block(row).requests():
                    buckets = (hashes >> shift).astype(np.int64)
                    firsts = np.flatnonzero(np.diff(buckets, prepend=-1))
                    lasts = np.append(firsts[1:], len(buckets))
                    out = {name: [] for name in ("bucket", "kind", "block", "hashes", "train", "deleted")}
                    for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True):
                        out["bucket"].append(int(buckets[a]))
                        out["kind"].append(kind)
                        out["block"].append(row["block"])
                        out["hashes"].append(pack_sorted(hashes[a:b]))
                        out["train"].append(pack_integers(train[a:b]))
                        out["deleted"].append(pack_integers(deleted[a:b]))
                    yield pa.RecordBatch.from_pydict(out, pa_schema)

    integer, blob = pa.int64(), pa.binary()
    names = (("bucket", integer), ("kind", integer), ("block", integer))
    pa_schema = pa.schema([*names, ("hashes", blob), ("train", blob), ("deleted", blob)])
    ddl = "bucket long, kind long, block long, hashes binary, train binary, deleted binary"
    return blocks.select("block", "folds", "sizes", "vocabulary", "tokens").mapInArrow(ask, ddl)


_ANSWER = "block long, kind long, bucket long, train binary, deleted binary, types long, total long"


def _add_up(group: pa.Table) -> pa.Table:
    """Answers to one group of requests, in the order asked, and a row of totals with block -1."""
    hashes = [unpack_sorted(h.as_py()) for h in group["hashes"]]
    edges = np.cumsum([0, *map(len, hashes)])
    keys, which = np.unique(np.concatenate(hashes), return_inverse=True)
    sums = {}
    for name in ("train", "deleted"):
        asked = np.concatenate([unpack_integers(c.as_py()) for c in group[name]])
        sums[name] = np.bincount(which, asked.astype(float), len(keys)).astype(np.uint64)
    kind, bucket = group["kind"][0].as_py(), group["bucket"][0].as_py()
    size = len(group)
    answers = {
        name: [pack_integers(sums[name][which[a:b]]) for a, b in zip(edges, edges[1:], strict=False)]
        for name in sums
    }
    totals = int(np.count_nonzero(sums["train"])), int(sums["train"].sum())
    columns = [
        pa.array([*group["block"].to_pylist(), -1], pa.int64()),
        pa.array([kind] * (size + 1), pa.int64()),
        pa.array([bucket] * (size + 1), pa.int64()),
        pa.array([*answers["train"], b""], pa.binary()),
        pa.array([*answers["deleted"], b""], pa.binary()),
        pa.array([0] * size + [totals[0]], pa.int64()),
        pa.array([0] * size + [totals[1]], pa.int64()),
    ]
    return pa.Table.from_arrays(columns, ["block", "kind", "bucket", "train", "deleted", "types", "total"])


@dataclass(frozen=True)
class Totals:
    """Training tokens, those of the deleted part, and different tokens."""

    tokens: int
    deleted: int
    types: int


def _answers(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Training and deleted counts of a block's requests of a kind, in their order."""
    rows = [r for r in table.select(["kind", "bucket", "train", "deleted"]).to_pylist() if r["kind"] == kind]
    rows.sort(key=lambda r: r["bucket"])
    train = np.concatenate([unpack_integers(r["train"]) for r in rows]).astype(np.int64)
    return train, np.concatenate([unpack_integers(r["deleted"]) for r in rows]).astype(np.int64)


def _frequency_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the power of two below its count."""
    return np.frexp(counts.astype(float))[1]


_FREQUENCY_BUCKETS = 64


def _ratio(part: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(part)), where=np.asarray(whole) > 0)


# --- weights ------------------------------------------------------------------


def _events(block: Block, words: tuple, bigrams: tuple, totals: Totals) -> pa.Table:
    """Tokens of the deleted part by frequency bucket and step of both estimates, with these summed."""
    word, pair = words[0] - words[1], bigrams[0] - bigrams[1]
    context = word[block.before()]
    p1 = _ratio(word[block.tokens], totals.tokens - totals.deleted)
    p2 = _ratio(pair[block.bigrams()[1]], context)

    def steps(p: np.ndarray) -> np.ndarray:
        return np.where(p > 0, 1 - np.floor(_STEPS * np.log2(np.maximum(p, 1e-300))), 0).astype(np.int64)

    cell = (_frequency_bucket(context).astype(np.int64) << 40) | (steps(p2) << 20) | steps(p1)
    cells, which = np.unique(cell, return_inverse=True)
    columns = [pa.array(cells), pa.array(np.bincount(which))]
    columns += [pa.array(np.bincount(which, p, len(cells))) for p in (p1, p2)]
    return pa.Table.from_arrays(columns, ["cell", "n", "p1", "p2"])


def learn_weights(events: dict[str, np.ndarray], types: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the bigram, word and uniform estimates per frequency bucket, by expectation-maximisation.

    A bucket without events has the weights learned from all of them.
    """
    n, p0 = events["n"].astype(float), 1.0 / (types + 1)
    estimates = np.stack([events["p2"] / n, events["p1"] / n, np.full(len(n), p0)], axis=1) if len(n) else None
    buckets = events["cell"] >> 40

    def learned(chosen: np.ndarray) -> np.ndarray:
        weights = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = weights * estimates[chosen]
            share *= (n[chosen] / share.sum(axis=1))[:, None]
            # The uniform estimate never loses all weight: an unseen word must stay possible.
            weights = share.sum(axis=0) + [0, 0, 0.5]
            weights /= weights.sum()
        return weights

    if estimates is None:
        return np.tile([1 / 3, 1 / 3, 1 / 3] if types else [0.0, 0.0, 1.0], (_FREQUENCY_BUCKETS, 1))
    result = np.tile(learned(np.ones(len(n), bool)), (_FREQUENCY_BUCKETS, 1))
    for bucket in np.unique(buckets):
        result[bucket] = learned(buckets == bucket)
    return result


# --- scores -------------------------------------------------------------------


def _scores(block: Block, words: tuple, bigrams: tuple, totals: Totals, weights: np.ndarray) -> dict[str, np.ndarray]:
    word, pair = words[0], bigrams[0]
    own = word[block.tokens]
    context = word[block.before()]
    mix = weights[_frequency_bucket(context)]
    p2 = _ratio(pair[block.bigrams()[1]], context)
    p1 = _ratio(own, totals.tokens)
    model = np.log10(mix[:, 0] * p2 + mix[:, 1] * p1 + mix[:, 2] / (totals.types + 1))
    base = np.log10((own + 1) / (totals.tokens + totals.types + 1))
    firsts = np.cumsum(block.sizes) - block.sizes
    return {
        "n_tokens": block.sizes,
        "n_known": np.add.reduceat((own > 0).astype(np.int64), firsts),
        "base_score": np.add.reduceat(base, firsts),
        "score": np.add.reduceat(model, firsts),
    }


@dataclass(frozen=True)
class Counted:
    """Blocks, the counts they asked for, and the corpus totals."""

    blocks: DataFrame
    answers: DataFrame
    totals: Totals

    def per_block(self, deleted_only: bool, function, schema: str | StructType) -> DataFrame:
        """``function`` of each block's row, block and answers."""
        blocks = self.blocks.where("deleted") if deleted_only else self.blocks
        answers = self.answers.where("block >= 0")
        if deleted_only:
            answers = answers.join(blocks.select("block"), "block", "left_semi")

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            row = left.to_pylist()[0]
            return function(row, _read_block(row), _answers(right, _WORDS), _answers(right, _BIGRAMS))

        columns = ["block", "kind", "bucket", "train", "deleted"]
        return blocks.groupBy("block").cogroup(answers.select(columns).groupBy("block")).applyInArrow(run, schema)


def count_ngrams(documents: DataFrame, *, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> Counted:
    """Counts of all words and bigrams of the training texts, as far as each block asks for them."""
    blocks = stored(_block_rows(documents, key, text, block_bytes), "lm-blocks")
    groups = max(2, blocks.count())
    requests = _requests(blocks, groups)
    answers = stored(requests.groupBy("kind", "bucket").applyInArrow(_add_up, _ANSWER), "lm-answers")
    sums = answers.where((F.col("block") == -1) & (F.col("kind") == _WORDS))
    types, tokens = sums.agg(F.sum("types"), F.sum("total")).first()

    def deleted_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [int(unpack_integers(s.as_py()).sum()) for s in batch.column("sizes")]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n"])

    deleted = blocks.where("deleted").select("sizes").mapInArrow(deleted_tokens, "n long").agg(F.sum("n")).first()[0]
    return Counted(blocks, answers, Totals(tokens or 0, deleted or 0, types or 0))


def interpolation_weights(counted: Counted) -> np.ndarray:
    """Weights learned on the deleted part. What reaches the driver is bounded by the steps told apart."""
    totals = counted.totals
    found = counted.per_block(
        True,
        lambda row, block, words, bigrams: _events(block, words, bigrams, totals),
        "cell long, n long, p1 double, p2 double",
    )
    summed = found.groupBy("cell").agg(*(F.sum(name).alias(name) for name in ("n", "p1", "p2"))).toArrow()
    return learn_weights({name: summed[name].to_numpy() for name in summed.column_names}, totals.types)


def score_texts(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` per row."""
    counted = count_ngrams(documents, key=key, text=text, block_bytes=block_bytes)
    weights, totals = interpolation_weights(counted), counted.totals
    key_type = documents.schema[key].dataType
    rest = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    schema = StructType([StructField("key", key_type), *StructType.fromDDL(rest).fields])

    def score(row: dict, block: Block, words: tuple, bigrams: tuple) -> pa.Table:
        scores = _scores(block, words, bigrams, totals, weights)
        size = len(block.sizes)
        columns = [pa.array(row["keys"], to_arrow_type(key_type)), pa.array(block.folds == TEST_FOLD)]
        columns += [pa.array(scores["n_tokens"]), pa.array(scores["n_known"])]
        columns += [pa.array([totals.tokens] * size, pa.int64()), pa.array(scores["base_score"])]
        return pa.Table.from_arrays([*columns, pa.array(scores["score"])], names=schema.names)

    return counted.per_block(False, score, schema).withColumnRenamed("key", key)
