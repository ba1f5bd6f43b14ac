"""Similarity join of texts by the Jaccard similarity of their word shingles, through PartEnum signatures.

Equal sets are one class. Signatures (see :mod:`lakegauge.llm.shingles`) are sorted and packed per block of
documents, and those of a range of hashes meet in one group, which returns the classes that share a
signature; equal lists of classes are returned once. Two classes are compared by parity sketches first:
every element in one set and not in the other flips one bit, so sketches that differ in more bits than
linked sets can have elements apart rule the pair out. The rest is verified on the sets themselves: all pairs of
a list of one block at once, if it is short or the sketches leave no more pairs than its centres would make. Others, which
are crowds of near copies or longer than a block, go in rounds: every class with the list's centres first, a few
members chosen by hash; then, if the list does not lie in one component by now, every pair left between
components, or a spanning forest of the possible links and another round where these pairs are many. So a crowd of near copies costs rows by its
size, not by its pairs, texts that merely share a passage ship their sketches once for each list, and no pair goes unverified.

Edge cases: a null or empty text, or one of white space alone, has an empty set and is linked with
nothing; a null key is linked with nothing and has a null component; rows repeating a key join the
components of all its texts; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegauge.llm.columns import in_small_batches, possibly_among, stored, tasks_for
from lakegauge.llm.components import components, joined_further
from lakegauge.llm.packed import pack_integers, pack_sorted, unpack_integers, unpack_sorted
from lakegauge.llm.shingles import Sets, shingle_sets, signatures, signatures_per_element
from lakegauge.llm.textscan import mixed, scan, text_slices

WIDTH, SHARE = 4, 85

#: Text of which a task packs signatures together, and signatures meant to meet in one group.
BLOCK_BYTES = 16 << 20
GROUP_SIGNATURES = 750_000

#: Longer lists may be compared in rounds, all members with this many of them first.
SHORT = 48
CENTRES = 2
#: Pairs left per member up to which all of them are compared, without a forest first.
_PAIRS_LEFT = 64
#: Classes of a list compared at once, and bytes of their sketches; longer lists are cut into blocks.
BLOCK_CLASSES = 1024
BLOCK_SKETCHES = 4 << 20
#: Bytes of lists with their sketches that are meant to be compared in one group.
GROUP_BYTES = 8 << 20
_ROW_BYTES = 64
_FEW = 24


def _may_link(x: np.ndarray | int, y: np.ndarray | int, apart: np.ndarray | int, share: int):
    """Whether sets of these sizes differing in ``apart`` elements at least can be linked."""
    return (100 + share) * apart <= (100 - share) * (x + y)


# --- sets and signatures ------------------------------------------------------


def _sketch_bits(sizes: np.ndarray) -> np.ndarray:
    """Bits of the sketch of a set: the power of two from twice its size, 64 at least."""
    return np.maximum(64, 1 << np.ceil(np.log2(np.maximum(2 * sizes, 1))).astype(np.int64))


def parity_sketches(sets: Sets) -> list[bytes]:
    """For each set, which of the places its elements are hashed to hold an odd number of them."""
    bits = _sketch_bits(sets.sizes)
    ends = np.cumsum(bits)
    owner = np.repeat(np.arange(len(bits)), sets.sizes)
    place = (mixed(sets.values ^ np.uint64(0x5851F42D4C957F2D)) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(place + (ends - bits)[owner], minlength=int(ends[-1]) if len(ends) else 0) & 1
    data = np.packbits(odd.astype(bool), bitorder="little").tobytes()
    return [data[(e - b) // 8 : e // 8] for e, b in zip(ends.tolist(), bits.tolist(), strict=True)]


def _folded(sketch: int, bits: int, to: int) -> int:
    """The sketch of the same set with fewer bits."""
    while bits > to:
        bits //= 2
        sketch = (sketch >> bits) ^ (sketch & ((1 << bits) - 1))
    return sketch


def _sets_of(documents: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``key, n_shingles, class, sketch`` of every row; ``class`` is the hash of its set."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rest = StructType.fromDDL("n_shingles long, class long, sketch binary").fields
    schema = StructType([rows.schema["key"], *rest])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_slices(batch.column("text")):
                part = batch.slice(start, end - start)
                sets = shingle_sets(scan(part.column("text")), width)
                columns = [part.column("key"), pa.array(sets.sizes.astype(np.int64))]
                columns += [pa.array(sets.keys().view(np.int64)), pa.array(parity_sketches(sets), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(find, schema)


def _signature_rows(documents: DataFrame, text: str, width: int, share: int, groups: int) -> DataFrame:
    """Signatures by range of hashes, packed: ``bucket, signatures, owners, classes``."""
    shift = np.uint64(64 - max(1, (groups - 1).bit_length()))

    def packed(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        classes, owners = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        values = np.concatenate([f[1] for f in found])
        order = np.argsort(values)
        values, owners = values[order], owners[order]
        buckets = (values >> shift).astype(np.int64)
        firsts = np.flatnonzero(np.diff(buckets, prepend=-1)).tolist()
        out = {"bucket": [], "signatures": [], "owners": [], "classes": []}
        for a, b in zip(firsts, [*firsts[1:], len(values)], strict=True):
            here, numbers = np.unique(owners[a:b], return_inverse=True)
            out["bucket"].append(int(buckets[a]))
            out["signatures"].append(pack_sorted(values[a:b]))
            out["owners"].append(pack_integers(numbers))
            out["classes"].append(pack_sorted(classes[here]))
        blob = pa.binary()
        names = (("bucket", pa.int64()), ("signatures", blob), ("owners", blob), ("classes", blob))
        return pa.RecordBatch.from_pydict(out, pa.schema(names))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, seen = [], 0, set()
        for batch in batches:
            texts = batch.column("text")
            for start, end in text_slices(texts):
                part = texts.slice(start, end - start)
                sets = shingle_sets(scan(part), width)
                keys = sets.keys()
                # Copies within a block sign once.
                new = np.array([k not in seen and not seen.add(k) for k in keys.tolist()], bool)
                for owners, values in signatures(sets, share):
                    chosen = new[owners]
                    found.append((keys[owners[chosen]], values[chosen]))
                held += part.nbytes
                if held >= BLOCK_BYTES and found:
                    yield packed(found)
                    found, held, seen = [], 0, set()
        if found and sum(len(f[0]) for f in found):
            yield packed(found)

    ddl = "bucket long, signatures binary, owners binary, classes binary"
    return documents.select(F.col(text).alias("text")).mapInArrow(sign, ddl)


def _meet(rows: pa.Table) -> pa.Table:
    """Lists of two or more classes sharing a signature: ``list`` (hash of its classes), ``class``, the number ``n`` of
    them, and the ``centres`` of a long list: the classes that are least by a hash, one hash for each."""
    values = np.concatenate([unpack_sorted(s.as_py()) for s in rows["signatures"]])
    owners = np.concatenate(
        [
            unpack_sorted(c.as_py())[unpack_integers(o.as_py()).astype(np.int64)]
            for o, c in zip(rows["owners"], rows["classes"], strict=True)
        ]
    )
    order = np.lexsort((owners, values))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[new], owners[new]
    firsts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    sizes = np.diff(firsts, append=len(values))
    hashes = mixed(np.add.reduceat(mixed(owners), firsts) ^ sizes.astype(np.uint64))
    shared = np.flatnonzero(sizes > 1)
    _, once = np.unique(hashes[shared], return_index=True)
    shared = shared[once]
    places = np.repeat(firsts[shared], sizes[shared]) + _within(sizes[shared])
    members, counts = owners[places], sizes[shared]
    starts = np.cumsum(counts) - counts
    centres: list[list[int] | None] = [None] * len(shared)
    for at in np.flatnonzero(counts > SHORT).tolist():
        own = members[starts[at] : starts[at] + counts[at]]
        centres[at] = [int(own[mixed(own ^ np.uint64(c)).argmin()].view(np.int64)) for c in range(CENTRES)]
    number = pa.array(np.repeat(np.arange(len(shared)), counts))
    return pa.table(
        {
            "list": np.repeat(hashes[shared], counts).view(np.int64),
            "class": members.view(np.int64),
            "n": np.repeat(counts, counts).astype(np.int64),
            "centres": pa.array(centres, pa.list_(pa.int64())).take(number),
        }
    )


def _within(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


# --- comparison ---------------------------------------------------------------


def _adjacency(sizes: np.ndarray, sketches: list[bytes], share: int) -> np.ndarray:
    """Which of many sets may be linked, as a matrix."""
    least = min(map(len, sketches)) * 8
    folded = [_folded(int.from_bytes(s, "little"), len(s) * 8, least).to_bytes(least // 8, "little") for s in sketches]
    words = np.frombuffer(b"".join(folded), np.uint64).reshape(len(sketches), -1)
    near = np.empty((len(sizes), len(sizes)), bool)
    step = max(1, (1 << 21) // words.size)
    for at in range(0, len(sizes), step):
        apart = np.bitwise_count(words[at : at + step, None, :] ^ words[None]).sum(axis=2, dtype=np.int64)
        near[at : at + step] = _may_link(sizes[at : at + step, None], sizes[None], apart, share)
    return near


def _forest(near: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest."""
    seen = np.zeros(len(near), bool)
    for root in range(len(near)):
        if seen[root]:
            continue
        seen[root] = True
        waiting = [root]
        while waiting:
            node = waiting.pop()
            found = np.flatnonzero(near[node] & ~seen)
            seen[found] = True
            yield from ((node, other) for other in found.tolist())
            waiting += found.tolist()


def _near(sizes: np.ndarray, sketches: list[bytes], share: int) -> np.ndarray:
    """:func:`_adjacency`, without arrays where the sets are few."""
    if len(sizes) > _FEW:
        return _adjacency(sizes, sketches, share)
    near = np.zeros((len(sizes), len(sizes)), bool)
    numbers = [int.from_bytes(s, "little") for s in sketches]
    for i in range(len(sizes)):
        for j in range(i):
            bits = len(sketches[i]) * 8, len(sketches[j]) * 8
            least = min(bits)
            apart = (_folded(numbers[i], bits[0], least) ^ _folded(numbers[j], bits[1], least)).bit_count()
            near[i, j] = near[j, i] = _may_link(int(sizes[i]), int(sizes[j]), apart, share)
    return near


def _compare(unit: pa.Table, share: int) -> pa.Table:
    """Pairs of classes of a list in different components that sketches do not rule out: all where they are ``few``,
    or those of a spanning forest."""
    lists, classes, groups = (unit[n].to_numpy() for n in ("list", "class", "component"))
    sizes, blocks, few = (unit[n].to_numpy() for n in ("n_shingles", "block", "few"))
    sketches = unit["sketch"].combine_chunks()
    high = unit["high"][0].as_py()
    crossing = unit["low"][0].as_py() != high
    order = np.lexsort((classes, lists))
    firsts = np.flatnonzero(np.diff(lists[order], prepend=lists[order[0]] - 1)).tolist()
    found: list[np.ndarray] = [np.empty((0, 2), np.int64)]
    for a, b in zip(firsts, [*firsts[1:], len(lists)], strict=True):
        own = order[a:b]
        if (groups[own] == groups[own[0]]).all():
            continue
        near = _near(sizes[own], sketches.take(pa.array(own)).to_pylist(), share)
        near &= groups[own, None] != groups[None, own]
        if crossing:
            near &= (blocks[own, None] == high) != (blocks[None, own] == high)
        edges = np.argwhere(np.triu(near)) if few[own[0]] else np.array(list(_forest(near)), np.int64).reshape(-1, 2)
        found.append(np.sort(classes[own[edges]], axis=1))
    different = np.unique(np.concatenate(found), axis=0)
    return pa.table({"a": different[:, 0], "b": different[:, 1]})


def _block_pairs(unit: pa.Table, share: int) -> pa.Table:
    """Pairs ``a, b`` of classes of a list that sketches do not rule out, or the ``list`` if it is long and has more of them
    than its centres would make."""
    lists, classes, sizes = (unit[n].to_numpy() for n in ("list", "class", "n_shingles"))
    sketches = unit["sketch"].combine_chunks()
    order = np.lexsort((classes, lists))
    firsts = np.flatnonzero(np.diff(lists[order], prepend=lists[order[0]] - 1)).tolist()
    found: list[np.ndarray] = [np.empty((0, 2), np.int64)]
    crowds = []
    for a, b in zip(firsts, [*firsts[1:], len(lists)], strict=True):
        own = order[a:b]
        near = _near(sizes[own], sketches.take(pa.array(own)).to_pylist(), share)
        edges = np.argwhere(np.triu(near, 1))
        if len(own) > SHORT and len(edges) > CENTRES * len(own):
            crowds.append(lists[own[0]])
        else:
            found.append(classes[own[edges]])
    different = np.unique(np.concatenate(found), axis=0)
    none, gaps = pa.nulls(len(different), pa.int64()), pa.nulls(len(crowds), pa.int64())
    rows = [pa.table({"list": none, "a": different[:, 0], "b": different[:, 1]})]
    rows.append(pa.table({"list": pa.array(crowds, pa.int64()), "a": gaps, "b": gaps}))
    return pa.concat_tables(rows)


def _in_blocks(members: DataFrame, known: DataFrame, share: int) -> DataFrame:
    """Pairs ``a, b`` of members of lists of one block that sketches do not rule out, and the ``list`` of those left to
    the rounds. Lists go to groups whole, each member once."""
    size = known.agg(F.avg(F.octet_length("sketch") + _ROW_BYTES)).first()[0] or 0
    chunks = max(8, int(members.count() * size) // GROUP_BYTES)
    rows = members.select("list", "class").join(known.select("class", "n_shingles", "sketch"), "class")
    tasks = max(chunks, tasks_for(members))
    rows = rows.coalesce(tasks)
    rows = rows.select("list", "class", "n_shingles", "sketch", F.pmod("list", F.lit(chunks)).alias("chunk"))
    found = rows.groupBy("chunk").applyInArrow(lambda unit: _block_pairs(unit, share), "list long, a long, b long")
    return stored(found, "block-pairs", tasks=tasks)


def _central(members: DataFrame, known: DataFrame, share: int) -> DataFrame:
    """Pairs of each member of a list with its centres that sketches do not rule out."""
    tasks = tasks_for(members)
    pairs = members.select("class", F.explode("centres").alias("centre")).where("class <> centre")
    pairs = pairs.select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct()
    pairs = stored(pairs, "central-pairs", tasks=tasks)
    ends = known.select("class", "n_shingles", "sketch")
    first, second = ends.toDF("a", "x_size", "x"), ends.toDF("b", "y_size", "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                least = 8 * min(len(x), len(y))
                x, y = (_folded(int.from_bytes(s, "little"), 8 * len(s), least) for s in (x, y))
                apart.append((x ^ y).bit_count())
            sizes = (batch.column(n).to_numpy() for n in ("x_size", "y_size"))
            may = pa.array(_may_link(*sizes, np.array(apart, np.int64), share), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(n).filter(may) for n in "ab"], names=["a", "b"])

    both = pairs.join(first, "a").coalesce(tasks).join(second, "b").select("a", "b", "x_size", "y_size", "x", "y")
    return both.coalesce(tasks).mapInArrow(compare, "a long, b long")


def _open(members: DataFrame, joined: DataFrame) -> DataFrame:
    """``list``, ``class`` and ``component`` of the lists that do not lie in one component, whether the pairs left are
    ``few``, and whether a class is in the list's ``largest`` component."""
    rows = members.select("list", "class").join(joined.withColumnRenamed("node", "class"), "class", "left")
    tasks = tasks_for(members)
    rows = rows.select("list", "class", F.coalesce("component", "class").alias("component"))
    rows = stored(rows, "list-components", tasks=tasks)
    parts = rows.groupBy("list", "component").agg(F.count(F.lit(1)).cast("double").alias("n"))
    n, squares = F.sum("n"), F.sum(F.col("n") * F.col("n"))
    few = ((n * n - squares) / 2 <= _PAIRS_LEFT * n).alias("few")
    main = F.max_by("component", F.struct("n", "component")).alias("main")
    lists = parts.groupBy("list").agg(few, main, F.count(F.lit(1)).alias("parts")).where("parts > 1")
    rows = rows.join(stored(lists.select("list", "few", "main"), "open-lists", tasks=tasks), "list")
    rows = rows.select("list", "class", "component", "few", (F.col("component") == F.col("main")).alias("largest"))
    return stored(rows, "open-members", tasks=tasks)


def _pairs(open_members: DataFrame, known: DataFrame, share: int) -> DataFrame:
    """Pairs to verify among the members of open lists: all where they are few, or those of a forest.

    A list beyond one block has its largest component, which may be a crowd, cut into blocks by itself (numbered below
    zero), and these are compared with the blocks of the rest only, never with one another.
    """
    rows = open_members.join(known.select("class", "n_shingles", "sketch"), "class")
    rows = stored(rows, "open-sketches", tasks=tasks_for(open_members))
    size = F.octet_length("sketch") + _ROW_BYTES

    def blocks_of(part: Column) -> Column:
        number, held = F.count_if(part) / float(BLOCK_CLASSES), F.sum(F.when(part, size)) / float(BLOCK_SKETCHES)
        return F.ceil(F.greatest(number, held)).cast("int")

    largest, rest = F.col("largest"), ~F.col("largest")
    blocks = rows.groupBy("list").agg(
        blocks_of(largest).alias("crowd"),
        blocks_of(rest).alias("others"),
        (blocks_of(F.lit(True)) == 1).alias("whole"),
        F.sum(size).alias("bytes"),
    )
    blocks = stored(blocks, "list-blocks", tasks=tasks_for(open_members))
    total = blocks.agg(F.sum((F.col("crowd") + F.col("others")) * F.col("bytes"))).first()[0] or 0
    chunks = max(8, total // GROUP_BYTES)
    rows = rows.join(blocks, "list")
    dealt = F.xxhash64("class")
    rows = rows.withColumn(
        "block",
        F.when(F.col("whole"), 0)
        .when(largest, -1 - F.pmod(dealt, F.col("crowd")))
        .otherwise(F.pmod(dealt, F.col("others")))
        .cast("int"),
    )
    first = F.when(F.col("whole") | largest, F.lit(0)).otherwise(-F.col("crowd"))
    last = F.when(F.col("whole"), F.lit(0)).otherwise(F.col("others") - 1)
    rows = rows.withColumn("other", F.explode(F.sequence(first, last)))
    rows = rows.select(
        "list", "class", "component", "few", "n_shingles", "sketch", "block",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        F.pmod("list", F.lit(chunks)).alias("chunk"),
    )
    found = rows.groupBy("chunk", "low", "high").applyInArrow(lambda unit: _compare(unit, share), "a long, b long")
    tasks = max(chunks, tasks_for(open_members))
    return stored(found.coalesce(tasks).distinct(), "set-pairs", tasks=tasks)


def _verified(pairs: DataFrame, known: DataFrame, documents: DataFrame, key: str, text: str, width: int, share: int):
    """The pairs whose sets are similar enough, by the sets themselves."""
    tasks = tasks_for(pairs)
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    wanted = stored(known.join(ends, "class", "left_semi").select("first", "class"), "wanted-sets", tasks=tasks)
    rows = documents.select(F.col(key).alias("first"), F.col(text).alias("text"))
    rows = possibly_among(rows, "first", wanted.select("first")).join(wanted, "first")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_slices(batch.column("text")):
                part = batch.slice(start, end - start)
                sets = shingle_sets(scan(part.column("text")), width)
                right = pa.array(sets.keys().view(np.int64) == part.column("class").to_numpy())
                packed = pa.array([pack_sorted(sets[i]) for i in range(len(part))], pa.binary())
                columns = [part.column("class").filter(right), packed.filter(right)]
                yield pa.RecordBatch.from_arrays(columns, names=["class", "elements"])

    fetched = rows.select("class", "text").mapInArrow(fetch, "class long, elements binary")
    # A key on several rows with equal texts comes more than once.
    sets = stored(fetched.groupBy("class").agg(F.any_value("elements").alias("elements")), "sets", tasks=tasks)
    first = sets.select(F.col("class").alias("a"), F.col("elements").alias("x"))
    second = sets.select(F.col("class").alias("b"), F.col("elements").alias("y"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                left, right = unpack_sorted(x.as_py()), unpack_sorted(y.as_py())
                common = len(np.intersect1d(left, right, assume_unique=True))
                linked.append(100 * common >= share * (len(left) + len(right) - common))
            chosen = batch.filter(pa.array(linked, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], names=["a", "b"])

    both = pairs.join(first, "a").coalesce(tasks).join(second, "b").select("a", "b", "x", "y")
    return stored(both.coalesce(tasks).mapInArrow(verify, "a long, b long"), "set-links", tasks=tasks)


def _sharing_a_key(usable: DataFrame) -> DataFrame:
    """Pairs ``a, b`` joining the classes of keys that have several."""
    least = usable.groupBy("key").agg(F.min("class").alias("a"), F.max("class").alias("last")).where("a <> last")
    return usable.join(least, "key").where("class <> a").select("a", F.col("class").alias("b")).distinct()


@in_small_batches
def similar_texts(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    share: int = SHARE,
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id``, the least key reachable by links, of every row.

    Rows link where their sets of ``width``-word shingles have a Jaccard similarity of ``share`` hundredths.
    """
    sets = stored(_sets_of(documents, key, text, width), "shingle-sets")
    usable = sets.where((F.col("n_shingles") > 0) & F.col("key").isNotNull())
    shingles = sets.agg(F.sum("n_shingles")).first()[0] or 0
    groups = max(2, int(shingles * signatures_per_element(share) / GROUP_SIGNATURES))
    keyed = documents.where(F.col(key).isNotNull())
    signed = _signature_rows(keyed, text, width, share, groups)
    members = signed.groupBy("bucket").applyInArrow(_meet, "list long, class long, n long, centres array<long>")
    # A list found in several groups has the same centres in each.
    members = members.groupBy("list", "class").agg(F.any_value("n").alias("n"), F.any_value("centres").alias("centres"))
    members = stored(members, "set-lists")
    met = members.select("class").distinct()
    known = usable.join(met, "class", "left_semi").groupBy("class").agg(
        F.min("key").alias("first"),
        F.any_value("n_shingles").alias("n_shingles"),
        F.any_value("sketch").alias("sketch"),
    )
    known = stored(known, "known-sets", tasks=tasks_for(members))
    where = (documents, key, text, width, share)
    compared = _in_blocks(members.where(F.col("n") <= BLOCK_CLASSES), known, share)
    crowds = compared.where("list IS NOT NULL").select("list")
    long = members.where(F.col("n") > BLOCK_CLASSES).unionByName(
        members.where(F.col("n").between(SHORT + 1, BLOCK_CLASSES)).join(crowds, "list", "left_semi").select(*members.columns)
    )
    long = stored(long, "long-lists")
    pairs = compared.where("list IS NULL").select("a", "b").union(_central(long, known, share))
    pairs = stored(pairs.distinct(), "set-pairs", tasks=max(tasks_for(compared), tasks_for(long)))
    joined = components(_verified(pairs, known, *where), "a", "b")
    waiting = _open(long, joined)
    while not waiting.isEmpty():
        joined = joined_further(joined, _verified(_pairs(waiting, known, share), known, *where))
        # Where a forest was verified, whatever pairs are left come next.
        waiting = _open(waiting.where("NOT few"), joined).withColumn("few", F.lit(True))
    several = stored(_sharing_a_key(usable), "keys-with-sets")
    joined = joined_further(joined, several)

    classes = usable.groupBy("class").agg(F.min("key").alias("first"))
    rooted = joined.select(F.col("node").alias("class"), "component")
    rooted = rooted.unionByName(joined.select(F.col("component").alias("class"), "component").distinct())
    rooted = rooted.join(classes, "class")
    least = rooted.groupBy("component").agg(F.min("first").alias("least"))
    classes = classes.join(rooted.select("class", "component"), "class", "left").join(least, "component", "left")
    # Read back, both inputs of the join are plain shuffles, and a crowd of equal texts is split.
    classes = stored(classes.select("class", F.coalesce("least", "first").alias("component_id")), "set-classes")
    alone = sets.where((F.col("n_shingles") == 0) | F.col("key").isNull())
    result = usable.join(classes, "class").select("key", "n_shingles", "component_id")
    result = result.unionByName(alone.select("key", "n_shingles", F.col("key").alias("component_id")))
    return result.withColumnRenamed("key", key)


def one_of_each(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 5, share: int = 80
) -> DataFrame:
    """One row of each component of similar texts, its columns unchanged: the one of the least key, a null key
    coming last, and of the least hash of its text. Rows without words stay.

    Components are of texts: different texts of rows that repeat or lack a key have nothing to do with each other.
    """
    rows = documents.select(F.xxhash64(text).alias("text_hash"), F.col(key).alias("key"), F.col(text).alias("text"))
    found = similar_texts(rows, key="text_hash", width=width, share=share)
    found = found.where("n_shingles > 0").select("text_hash", "component_id").distinct()
    places = rows.select("text_hash", "key").join(found, "text_hash")
    places = places.groupBy("text_hash", "key").agg(
        F.count(F.lit(1)).alias("copies"), F.any_value("component_id").alias("component_id")
    )
    places = stored(places, "text-places")
    place = F.struct(F.col("key").isNull(), "key", "text_hash")
    firsts = places.groupBy("component_id").agg(F.min(place).alias("first"))
    marked = places.join(firsts, "component_id").withColumn("chosen", place.eqNullSafe(F.col("first")))
    # Rows chosen with copies are all taken out, and one of them put back.
    apart = marked.where("NOT chosen OR copies > 1").select(
        F.col("key").alias("__key"), F.col("text_hash").alias("__hash"), "chosen"
    )
    apart = stored(apart, "texts-apart")
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(text) == F.col("__hash"))
    kept = documents.join(apart, same, "left_anti")
    copied = stored(apart.where("chosen").drop("chosen"), "copied-texts")
    whole = documents.select(F.struct("*").alias("row")).withColumn("hash", F.xxhash64(F.col("row")[text]))
    whole = possibly_among(whole, "hash", copied.select("__hash"))
    same = F.col("row")[key].eqNullSafe(F.col("__key")) & (F.col("hash") == F.col("__hash"))
    single = whole.join(copied, same).groupBy("__key", "__hash").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return kept.unionByName(single.select(*(F.col("row")[n].alias(n) for n in documents.columns)))
