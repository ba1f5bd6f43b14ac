"""Lines repeated across a corpus, up to a few edits: a segment-partition join in built-in functions.

A line cut into ``EDITS + 1`` segments keeps one whole through ``EDITS`` edits. So every line is indexed
by its length and its segments, and looked up by those of its substrings that a segment of a line as long,
or up to ``EDITS`` shorter, can have become; the positions tried are the few that leave enough edits for
the parts on either side. What shares a key is verified by a bit-parallel edit distance over the band of
``2 * EDITS + 1`` diagonals.

Lines are known by a 64-bit hash, so hot lines are one row before any join. Lines shorter than
``MIN_CHARS`` characters are of one class where they are equal only: in these a few edits make other words. Texts of candidates
are fetched through a bit set of fixed size, small enough to be sent to every task whatever the corpus.

Edge cases: a null text has no lines; short lines without a word are never removed; the first line of a
class is its earliest by key and line number, a null key coming first, and by the hash of the text where
rows repeat a key or lack one; rows repeating a key and a text are one document; an empty table gives an empty result; extra columns are kept by :func:`drop_repeated_lines`
and not read otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegauge.llm.columns import let, possibly_among, stored
from lakegauge.llm.components import components

EDITS = 2
MIN_CHARS = 24

_INDEXED, _LOOKS = 0, 1
_SKETCHED = ("id", "letters", "pairs")


def _segment(length: Column, at: int, edits: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment ``at`` of a line of ``length`` characters."""
    parts = edits + 1
    start = F.floor(length * at / parts).cast("int")
    return start, F.floor(length * (at + 1) / parts).cast("int") - start


def _keys(line: Column, size: Column, edits: int) -> Column:
    """What a line is found by and looks for: an array of key ``k`` and ``kind``.

    As an indexed line it has the key of each of its segments. It looks for lines as long as itself or up
    to ``edits`` shorter: segment ``at`` of a line shorter by ``less`` may have moved by up to ``at`` places, counted
    from the front, and by up to ``edits - at``, counted from the back; it must be within both.

    A line as long that has a segment in the same place has its key too, and need not be looked for. With one
    insertion and one deletion at most, all that moves between lines of equal length moves to one side, and seen from
    the other line to the other: one of the two has a whole segment that has not moved, or moved forward.
    """

    def key(size: Column, at: int, start: Column, length: Column, kind: int) -> Column:
        hashed = F.xxhash64(size, F.lit(at), F.substring(line, start + 1, length))
        return F.struct(hashed.alias("k"), F.lit(kind).alias("kind"))

    keys = []
    for at in range(edits + 1):
        start, length = _segment(size, at, edits)
        keys.append(key(size, at, start, length, _INDEXED))
    one_sided = edits < 4
    for less in range(edits + 1):
        for at in range(edits + 1):
            start, length = _segment(size - less, at, edits)
            lowest, highest = max(-at, less - (edits - at)), min(at, less + (edits - at))
            for moved in range(lowest, highest + 1):
                if less or moved > 0 or moved < 0 and not one_sided:
                    keys.append(key(size - less, at, start + moved, length, _LOOKS))
    return F.array(*keys)


def within_edits(first: Column, second: Column, edits: int) -> Column:
    """Whether two strings of at least ``edits`` characters are at most ``edits`` edits apart.

    Column by column of the edit matrix, the differences between neighbouring cells of the band are kept
    as bits of an integer: bit ``b`` is the row ``b - edits`` below the diagonal. The cell on the band's lower
    rim counts the edits until it reaches the last row, and that row's cells count them from there on.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1

    def body(rows: Column, columns: Column) -> Column:
        height = F.size(rows)

        def step(state: Column, j: Column) -> Column:
            letter = F.get(columns, j - 1)
            equal = F.lit(0)
            for bit in range(width):
                row = j - edits + bit
                matches = (row >= 1) & (row <= height) & (F.get(rows, row - 1) == letter)
                equal = equal.bitwiseOR(F.when(matches, F.lit(1 << bit)).otherwise(F.lit(0)))
            return let(equal, lambda eq: advance(state, j, eq))

        def advance(state: Column, j: Column, eq: Column) -> Column:
            up, down = state["up"], state["down"]
            carried = (eq.bitwiseAND(up) + up).bitwiseXOR(up)
            diagonal = carried.bitwiseOR(eq).bitwiseOR(down).bitwiseAND(F.lit(full))
            return let(diagonal, lambda d: moved(state, j, d))

        def moved(state: Column, j: Column, diagonal: Column) -> Column:
            up, down = state["up"], state["down"]
            right = F.lit(full).bitwiseAND(down.bitwiseOR(F.bitwise_not(diagonal.bitwiseOR(up))))
            left = diagonal.bitwiseAND(up)
            beneath = F.shiftright(diagonal, 1)
            rim = F.lit(1) - F.shiftright(diagonal, width - 1)

            def at_last_row(bits: Column) -> Column:
                shifted = F.call_function("shiftright", bits, height - j + edits)
                return shifted.bitwiseAND(F.lit(1))

            change = F.when(j + edits <= height, rim).otherwise(at_last_row(right) - at_last_row(left))
            next_up = F.lit(full).bitwiseAND(left.bitwiseOR(F.bitwise_not(beneath.bitwiseOR(right))))
            return F.struct(
                next_up.alias("up"),
                beneath.bitwiseAND(right).alias("down"),
                (state["n"] + change).alias("n"),
            )

        begin = F.struct(
            F.lit(full & ~((1 << edits) - 1)).alias("up"), F.lit(0).alias("down"), F.lit(edits).alias("n")
        )
        return F.aggregate(F.sequence(F.lit(1), F.size(columns)), begin, step, lambda s: s["n"] <= edits)

    return let(F.split(first, ""), lambda rows: let(F.split(second, ""), lambda columns: body(rows, columns)))


def lines_of(documents: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """``key, text_hash, line_no, line, id`` of every line that is long enough or holds a word; ``id`` is its hash."""
    row = (F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"))
    lines = documents.select(*row, F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))
    kept = (F.length("line") >= min_chars) | F.col("line").rlike(r"[^\x20\x09-\x0D]")
    return lines.where(kept).withColumn("id", F.xxhash64("line"))


def _matches(lines: DataFrame, edits: int) -> DataFrame:
    """``key, id, kind`` of the keys that an indexed line shares with another line."""
    # Grouped by both, lines are hashed; an aggregate that holds a text would sort them.
    distinct = lines.groupBy("id", "line").agg(F.length("line").alias("size"))
    rows = distinct.select("id", F.explode(_keys(F.col("line"), F.col("size"), edits)).alias("key"))
    rows = rows.select("id", F.col("key.k").alias("key"), F.col("key.kind").alias("kind"))
    alike = Window.partitionBy("key")
    shared = (F.min("id").over(alike) != F.max("id").over(alike)) & (F.min("kind").over(alike) == _INDEXED)
    return rows.withColumn("shared", shared).where("shared").select("key", "id", "kind")


def _sketches(line: Column) -> tuple[Column, Column]:
    """For each of 64 places, whether an odd number of the line's characters, and of its pairs of
    neighbouring characters, is hashed to it. An edit flips at most two of the first and four of the second."""
    one = F.lit(1).cast("long")

    def flipped(hashed: Column, bits: Column) -> Column:
        return bits.bitwiseXOR(F.call_function("shiftleft", one, F.pmod(hashed, F.lit(64)).cast("int")))

    def letters(found: Column) -> Column:
        return F.aggregate(found, F.lit(0).cast("long"), lambda bits, c: flipped(F.hash(c), bits))

    def pairs(found: Column) -> Column:
        second = F.slice(found, 2, F.size(found))
        both = F.zip_with(found, second, lambda a, b: F.xxhash64(a, b))
        return F.aggregate(both, F.lit(0).cast("long"), lambda bits, h: flipped(h, bits))

    return letters(F.split(line, "")), pairs(F.split(line, ""))


def _candidates(matches: DataFrame, sketches: DataFrame, edits: int) -> DataFrame:
    """Pairs ``a, b`` of ids of different lines that share a key and may be as near as asked."""
    rows = matches.join(sketches, "id")
    found = rows.where(F.col("kind") == _INDEXED).select("key", *(F.col(c).alias(f"a_{c}") for c in _SKETCHED))
    asked = rows.select("key", "kind", *(F.col(c).alias(f"b_{c}") for c in _SKETCHED))
    # Lines that are both indexed by a key find each other both ways; one is enough.
    once = F.expr(f"a_id < b_id OR (kind = {_LOOKS} AND a_id <> b_id)")
    near = F.expr(f"bit_count(a_letters ^ b_letters) <= {2 * edits} AND bit_count(a_pairs ^ b_pairs) <= {4 * edits}")
    # The filter belongs to the join, so a crowd of lines sharing a key is compared but not handed on.
    same = F.col("i.key") == F.col("p.key")
    pairs = found.alias("i").join(asked.alias("p"), same & once & near)
    return pairs.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct()


def _texts(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, line`` of the lines with these ids."""
    passed = possibly_among(lines.select("id", "line"), "id", ids)
    return passed.groupBy("id").agg(F.any_value("line").alias("line")).join(ids, "id", "left_semi")


def line_links(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """Pairs ``a, b`` of ids of different lines at most ``edits`` edits apart."""
    matches = stored(_matches(lines, edits), "line-matches")
    ids = stored(matches.select("id").distinct(), "line-ids")
    letters, pairs = _sketches(F.col("line"))
    texts = _texts(lines, ids).select("id", "line", letters.alias("letters"), pairs.alias("pairs"))
    texts = stored(texts, "line-texts")
    pairs = _candidates(matches, texts.select(*_SKETCHED), edits)
    first = texts.select(F.col("id").alias("a"), F.col("line").alias("first"))
    second = texts.select(F.col("id").alias("b"), F.col("line").alias("second"))
    both = pairs.join(first, "a").join(second, "b")
    return both.where(within_edits(F.col("first"), F.col("second"), edits)).select("a", "b")


def _marked_lines(documents: DataFrame, key: str, text: str, edits: int, min_chars: int) -> DataFrame:
    """``key, text_hash, line_no`` of every line of :func:`lines_of`, its ``class_place``, ``n_links`` and ``kept``."""
    lines = lines_of(documents, key, text, min_chars)
    links = stored(line_links(lines.where(F.length("line") >= min_chars), edits), "line-links")
    place = F.struct("key", "line_no", "text_hash")
    firsts = stored(lines.groupBy("id").agg(F.min(place).alias("place")), "line-places")

    ends = links.select(F.col("a").alias("id")).unionAll(links.select(F.col("b").alias("id")))
    degrees = ends.groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    joined = components(links, "a", "b")
    linked = degrees.join(joined, F.col("id") == F.col("node"), "left").select(
        "id", "n_links", F.coalesce("component", "id").alias("class")
    )
    linked = stored(linked.join(firsts, "id"), "linked-lines")
    earliest = linked.groupBy("class").agg(F.min("place").alias("class_place"))
    linked = linked.join(earliest, "class").select("id", "n_links", "class_place")

    known = firsts.join(linked, "id", "left").select(
        "id",
        F.coalesce("class_place", "place").alias("class_place"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
    # Read back, both inputs of the join are plain shuffles, and a line that is very common is split.
    known = stored(known, "known-lines")
    marked = lines.select("key", "text_hash", "line_no", "id").join(known, "id")
    return marked.select("*", place.eqNullSafe(F.col("class_place")).alias("kept"))


def line_classes(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """Every line with a word, and every other of at least ``min_chars`` characters: ``key``, ``line_no``, the ``class_doc``
    and ``class_line`` where its class first occurs, ``n_links`` (other different lines linked to it) and ``kept``.

    Lines shorter than ``min_chars`` belong together where they are equal, the others from ``edits`` edits on.
    """
    return _marked_lines(documents, key, text, edits, min_chars).select(
        F.col("key").alias(key),
        "line_no",
        F.col("class_place.key").alias("class_doc"),
        F.col("class_place.line_no").alias("class_line"),
        "n_links",
        "kept",
    )


def drop_repeated_lines(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``documents`` without the lines that a class has earlier; all other columns as they were.

    A document that keeps no line with a character in it is left out; one that had none stays as it is.
    """
    marked = _marked_lines(documents, key, text, edits, min_chars)
    document = (F.col("key").alias("__key"), F.col("text_hash").alias("__hash"))
    dropped = marked.where("NOT kept").groupBy(*document).agg(F.collect_set("line_no").alias("__dropped"))
    rows = documents.select(F.struct("*").alias("row"))
    whole = F.col("row")[text]
    same = F.col("row")[key].eqNullSafe(F.col("__key")) & (F.xxhash64(whole) == F.col("__hash"))
    rows = rows.join(dropped, same, "left")
    rest = F.filter(F.split(whole, "\n", -1), lambda line, at: ~F.array_contains("__dropped", at))
    kept = F.when(F.col("__dropped").isNull(), whole).otherwise(F.array_join(rest, "\n"))
    rows = rows.select("row", "__dropped", kept.alias("__kept"))
    rows = rows.where(F.col("__dropped").isNull() | F.col("__kept").rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(*(F.col("__kept" if n == text else f"row.`{n}`").alias(n) for n in documents.columns))
