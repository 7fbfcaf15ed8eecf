"""Values of a large gazetteer in texts: one pass over each text, met on anchors.

A value of up to EXACT bytes is its own anchor: many short values share any n-gram that is shorter than they are.  The anchor of a longer
one is the byte n-gram of least hash in it, and a text gives out only those that are least in some window that fits into
the value; the longest ones have it with as many steps of bytes around it as they hold, as near copies share n-grams.  So wherever the value occurs, its anchor is given out, and the work on a text does not depend on how many
values there are, only on how many short lengths occur.

A gazetteer of at most MAX_BYTES (measured first) goes to the executors as sorted anchors; hits are compared
with the values where the text lies, and nothing is shuffled.  A larger one is met by equi-join: blocks of neighbouring texts give
out their anchors, each once, without those that a filter of some bits per value knows no value to have; the entries that are joined to them
go to the block, where texts meet them as they meet a small gazetteer.  Texts and entries are kept and shuffled as compressed streams of
rows, and entries once per block, not once per text.  Both ways give the same rows.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..session import drop_dir, fresh_dir, ship_package, shuffles_dropped

EXACT = 22
#: (n-gram length, window): one level for every length up to EXACT, one for those below the next, one for the rest.
LEVELS = ((1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (24, 32), (16, 8), *((n, 1) for n in range(5, EXACT + 1)))
_LEVEL_OF = np.array([-1, 0, 1, 2, 3, *range(7, 7 + EXACT - 4), *[6] * (55 - EXACT - 1), 5])
#: Values of the last level have their n-gram with up to so many steps of so many bytes before and after it.
_LAST, _STEP, _STEPS = 5, 16, 3
MAX_BYTES = 64 << 20
#: Bits of the filter per value at least, bits of it at most (as a power of two), and what its places are made with.
FILTER_SHARE, FILTER_MOST = 24, 30
_PROBES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SLICE = 64
#: Bytes of the texts of a block, and of entries that are packed together.
BLOCK_BYTES, PACK_BYTES = 8 << 20, 32 << 20
_MULT = 0x9E3779B97F4A7C15
_powers: dict[bool, np.ndarray] = {}


def _power(inverse: bool, n: int) -> np.ndarray:
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        base = pow(_MULT, -1, 1 << 64) if inverse else _MULT
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _powers[inverse] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _running(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of every stretch of bytes follows."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(False, len(data)), out=sums[1:])
    return sums


def _stretch(sums: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    return _mix((sums[start + length] - sums[start]) * _power(True, len(sums))[start] + np.asarray(length).astype(np.uint64))


def _stretches(sums: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all stretches of one length, from the first place on: `_stretch` without looking up places."""
    h = sums[length:] - sums[:-length]
    h *= _power(True, len(sums))[: len(h)]
    h += np.uint64(length)
    turned = h >> np.uint64(32)
    for shift, factor in ((29, 0xBF58476D1CE4E5B9), (32, 0x94D049BB133111EB)):
        h ^= turned
        h *= np.uint64(factor)
        np.right_shift(h, np.uint64(shift), out=turned)
    h ^= turned
    return h


def _bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where rows begin; a null reads as an empty text."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def level_of(length: np.ndarray) -> np.ndarray:
    return _LEVEL_OF[np.minimum(length, len(_LEVEL_OF) - 1)]


def _power_for(n: int) -> int:
    """Size of the filter for n anchors, as a power of two."""
    return min(FILTER_MOST, max(10, int(np.ceil(np.log2(max(1, n) * FILTER_SHARE)))))


def _word(anchors: np.ndarray, factor: int, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of the filter, and products whose middle bits name bits of a word."""
    mixed = anchors * np.uint64(factor)
    return mixed >> np.uint64(70 - power), mixed


def _bits(mixed: np.ndarray) -> np.ndarray:
    """Four bits of a word; the first is that of _first_bit."""
    out = np.zeros(len(mixed), np.uint64)
    for shift in (8, 14, 20, 26):
        out |= np.uint64(1) << ((mixed >> np.uint64(shift)) & np.uint64(63))
    return out


def _first_bit(mixed: np.ndarray, held: np.ndarray) -> np.ndarray:
    return (held >> ((mixed >> np.uint64(8)) & np.uint64(63))) & np.uint64(1) == 1


def _filter_of(anchors: np.ndarray) -> np.ndarray:
    power = _power_for(len(anchors))
    words = np.zeros(1 << (power - 6), np.uint64)
    for factor in _PROBES:
        place, mixed = _word(anchors, factor, power)
        np.bitwise_or.at(words, place, _bits(mixed))
    return words


def _passing(words: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Places of the anchors that the filter may hold."""
    power, kept = len(words).bit_length() + 5, None
    for factor in _PROBES:
        place, mixed = _word(anchors if kept is None else anchors[kept], factor, power)
        held = words[place]
        some = np.flatnonzero(_first_bit(mixed, held))
        bits = _bits(mixed[some])
        some = some[held[some] & bits == bits]
        kept = some if kept is None else kept[some]
    return kept


def _spread(values: np.ndarray, window: int, pick) -> np.ndarray:
    """pick (least or greatest) over every `window` neighbours, a power of two."""
    done = 1
    while done < window:
        values = pick(values[:-done], values[done:])
        done *= 2
    return values


def _around(sums: np.ndarray, at: np.ndarray, gram: int, before, after) -> np.ndarray:
    """Anchors of the last level at these places, with steps of bytes before and after."""
    code = np.asarray(_LAST + 64 * (1 + before * (_STEPS + 1) + after)).astype(np.uint64)
    return _stretch(sums, at - _STEP * before, gram + _STEP * (before + after)) ^ code


def _given(row: np.ndarray, words: np.ndarray | None, at: np.ndarray | None, before: int, after: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (None: all) and anchors that the filter may hold and whose bytes lie in one row."""
    kept = np.arange(len(hashes)) if words is None else _passing(words, hashes)
    at, hashes = kept if at is None else at[kept], hashes[kept]
    inside = row[at - before] == row[at + after - 1]
    return at[inside], hashes[inside]


def text_anchors(data: np.ndarray, places: np.ndarray, levels: list[int], words: np.ndarray | None = None):
    """Per level: (level, byte place, hash) of what texts give out and the filter `words` may hold, without n-grams that cross rows."""
    sums = _running(data)
    row = np.repeat(np.arange(len(places) - 1, dtype=np.int32), np.diff(places))
    for level in levels:
        gram, window = LEVELS[level]
        if len(data) < gram:
            continue
        hashes = _stretches(sums, gram)
        if window > 1:
            if len(hashes) < window:
                continue
            least = _spread(hashes, window, np.minimum)
            # The greatest of the windows that hold a place; edges belong to fewer windows.
            edge = np.zeros(window - 1, np.uint64)
            most = _spread(np.concatenate([edge, least, edge]), window, np.maximum)
            at = np.flatnonzero(most == hashes)
        if level == _LAST:
            for before, after in np.ndindex(_STEPS + 1, _STEPS + 1):
                fits = (at >= _STEP * before) & (at + gram + _STEP * after <= len(data))
                yield level, *_given(row, words, at[fits], _STEP * before, gram + _STEP * after, _around(sums, at[fits], gram, before, after))
        elif window > 1:
            yield level, *_given(row, words, at, 0, gram, hashes[at] ^ np.uint64(level))
        else:
            hashes ^= np.uint64(level)
            yield level, *_given(row, words, None, 0, gram, hashes)


@dataclass
class Anchored:
    """Values with their anchors, ascending by anchor; `entry` is the place of a value in the table."""

    anchor: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    whole: np.ndarray
    entry: np.ndarray
    words: np.ndarray | None = None

    @classmethod
    def of(cls, values) -> "Anchored":
        data, places = _bytes_of(values)
        length, sums = np.diff(places), _running(data)
        anchor, offset = np.zeros(len(length), np.uint64), np.zeros(len(length), np.int64)
        levels = level_of(length)
        for level in np.unique(levels[length > 0]).tolist():
            gram = LEVELS[level][0]
            mine = np.flatnonzero((levels == level) & (length > 0))
            n = length[mine] - gram + 1
            ends = np.cumsum(n)
            at = np.arange(ends[-1]) + np.repeat(places[mine] - ends + n, n)
            hashes = _stretch(sums, at, gram)
            first = ends - n
            least = np.minimum.reduceat(hashes, first)
            hit = np.flatnonzero(hashes == np.repeat(least, n))
            owner = np.repeat(np.arange(len(mine)), n)[hit]
            head = np.unique(owner, return_index=True)[1]
            anchor[mine] = least ^ np.uint64(level)
            offset[mine] = at[hit[head]] - places[mine]
            if level == _LAST:
                before, after = (np.minimum(_STEPS, room // _STEP) for room in (offset[mine], length[mine] - offset[mine] - gram))
                anchor[mine] = _around(sums, places[mine] + offset[mine], gram, before, after)
        whole = _stretch(sums, places[:-1], length)
        order = np.lexsort((length, anchor))
        order = order[length[order] > 0]
        return cls(anchor[order], offset[order], length[order], whole[order], order)

    def levels(self) -> list[int]:
        return np.unique(level_of(self.length)).tolist()

    def found_in(self, column, values: list[bytes], levels: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(row, entry) of every value in every text, each once, ascending."""
        data, places = _bytes_of(column)
        rows, entries, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], _running(data)
        row_of = np.repeat(np.arange(len(places) - 1), np.diff(places))
        if self.words is None:
            self.words = _filter_of(self.anchor)
        for _, at, hashes in text_anchors(data, places, levels, self.words):
            low, high = np.searchsorted(self.anchor, hashes, "left"), np.searchsorted(self.anchor, hashes, "right")
            met = np.flatnonzero(high > low)
            n = (high - low)[met]
            ends = np.cumsum(n)
            which = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low[met] - ends + n, n)
            at, row = np.repeat(at[met], n), np.repeat(row_of[at[met]], n)
            start, length = at - self.offset[which], self.length[which]
            fits = (start >= places[row]) & (start + length <= places[row + 1])
            which, start, row = which[fits], start[fits], row[fits]
            same = _stretch(sums, start, self.length[which]) == self.whole[which]
            rows.append(row[same])
            entries.append(self.entry[which[same]])
            start = start[same]
            exact = [data[s : s + len(values[e])].tobytes() == values[e] for s, e in zip(start.tolist(), entries[-1].tolist())]
            rows[-1], entries[-1] = rows[-1][exact], entries[-1][exact]
        row, entry = np.concatenate(rows), np.concatenate(entries)
        order = np.lexsort((entry, row))
        row, entry = row[order], entry[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (entry[1:] != entry[:-1])
        return row[new], entry[new]


def _matched(table: pa.Table | pa.RecordBatch, texts, known: Anchored, struct: pa.StructArray, values: list[bytes], levels: list[int]):
    """Arrays of the entries (of `struct`) in slices of these texts, with the rows of `table` that they belong to."""
    for begin in range(0, table.num_rows, _SLICE):
        part = table.slice(begin, _SLICE)
        row, entry = known.found_in(texts.slice(begin, _SLICE), values, levels)
        edges = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
        yield part, pa.ListArray.from_arrays(pa.array(edges), struct.take(pa.array(entry)))


def _in_place(df: DataFrame, table: DataFrame, text: str, out: str, fields: list[str], value: str) -> DataFrame:
    held = table.select(*fields).orderBy(fields[0]).toArrow()  # MAX_BYTES at most
    struct = pa.StructArray.from_arrays([held.column(f).combine_chunks() for f in fields], fields)
    shared = df.sparkSession.sparkContext.broadcast((Anchored.of(held.column(value)), struct))
    kept = [f for f in df.schema.fields if f.name != out]
    answer = StructField(out, ArrayType(table.select(*fields).schema))
    schema = StructType([*kept, StructField("__text", df.schema[text].dataType), answer])

    def work(batches):
        known, struct = shared.value
        values = struct.field(fields.index(value)).cast(pa.binary()).to_pylist()
        levels = known.levels()
        for whole in batches:
            for batch, found in _matched(whole, whole.column(whole.num_columns - 1), known, struct, values, levels):
                yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, out])

    return df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(text).alias("__text")).mapInArrow(work, schema).drop("__text")


def _stream(table: pa.Table) -> tuple[int, bytes]:
    """Size and bytes of a compressed stream of these rows."""
    stream = pa.BufferOutputStream()
    with pa.ipc.new_stream(stream, table.schema) as writer:
        writer.write_table(table)
    raw = stream.getvalue()
    return len(raw), pa.Codec("zstd", compression_level=6).compress(raw, asbytes=True)


def _packed(blocks, streams: list[tuple[int, bytes]]) -> pa.RecordBatch:
    sizes, rows = zip(*streams)
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(sizes, pa.int64()), pa.array(rows, pa.binary())], ["__block", "size", "rows"])


def _unpacked(streams: pa.Table | pa.RecordBatch) -> pa.Table | None:
    codec, parts = pa.Codec("zstd"), []
    for size, rows in zip(streams.column("size").to_pylist(), streams.column("rows").to_pylist()):
        parts.append(pa.ipc.open_stream(codec.decompress(rows, size)).read_all())
    return pa.concat_tables(parts).combine_chunks() if parts else None


_PACKED = "__block long, size long, rows binary"


def _in_blocks(df: DataFrame, text: str) -> DataFrame:
    """Neighbouring rows as streams, each with a number and about BLOCK_BYTES of `text`."""
    most = BLOCK_BYTES

    def work(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            if batch.num_rows:
                part = _bytes_of(batch.column(text))[1][:-1] // most
                first = np.flatnonzero(np.diff(part, prepend=-1))
                for a, b in zip(first, [*first[1:], batch.num_rows]):
                    yield _packed([block], [_stream(pa.Table.from_batches([batch.slice(a, b - a)]))])
                    block += 1

    return df.mapInArrow(work, _PACKED)


def _by_block(df: DataFrame) -> DataFrame:
    """Rows of one block as streams, as far as a task holds them together."""
    most = PACK_BYTES

    def streams(held):
        table = pa.Table.from_batches(held).combine_chunks()
        number = table.column("__block").to_numpy()
        order = np.argsort(number, kind="stable")
        number, table = number[order], table.drop_columns(["__block"]).take(pa.array(order))
        first = np.flatnonzero(np.diff(number, prepend=number[0] - 1))
        return _packed(number[first], [_stream(table.slice(a, b - a)) for a, b in zip(first, [*first[1:], len(number)])])

    def work(batches):
        held, volume = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                volume += batch.nbytes
            if volume >= most:
                yield streams(held)
                held, volume = [], 0
        if held:
            yield streams(held)

    return df.mapInArrow(work, _PACKED)


def _saved(df: DataFrame, purpose: str, compression: str = "none") -> tuple[str, DataFrame]:
    """Where it lies, and the saved rows.  Rows may be large, so sizes are looked at after each."""
    path, each = fresh_dir(df.sparkSession, purpose), {f"parquet.{x}.size.row.check.min": "1" for x in ("page", "block")}
    with shuffles_dropped(df.sparkSession):
        df.write.options(**(each if compression == "none" else {}), compression=compression).parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def _with_anchors(table: DataFrame, fields: list[str], value: str, by_number: bool) -> DataFrame:
    """`fields` and the anchors of the entries; `by_number`, the first field is replaced by numbers in the order of rows by `fields`."""

    def anchored(batches):
        # Rows that are equal share a number.
        before, number = None, TaskContext.get().partitionId() << 40
        for batch in batches:
            columns = list(batch.columns)
            if by_number:
                numbers = []
                for row in zip(*(c.to_pylist() for c in columns)):
                    number += row != before
                    before = row
                    numbers.append(number)
                columns[0] = pa.array(numbers, pa.int64())
            known = Anchored.of(columns[fields.index(value)])
            rows = pa.RecordBatch.from_arrays(columns, fields).take(pa.array(known.entry))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(known.anchor.view(np.int64))], [*fields, "__anchor"])

    named = table.select(*fields)
    types = list(named.schema.fields)
    if by_number:
        named, types[0] = named.orderBy(*fields), StructField(fields[0], LongType())
    return named.mapInArrow(anchored, StructType(types).add("__anchor", "long"))


def _filter_over(entries: DataFrame) -> np.ndarray:
    power = _power_for(entries.count())

    def placed(batches):
        for batch in batches:
            both = [_word(np.asarray(batch.column(0)).view(np.uint64), factor, power) for factor in _PROBES]
            place, bits = np.concatenate([p for p, _ in both]), np.concatenate([_bits(m) for _, m in both])
            yield pa.RecordBatch.from_arrays([pa.array(place.view(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    bits = entries.select("__anchor").mapInArrow(placed, "word long, bits long")
    held = bits.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # 2^FILTER_MOST / 64 numbers at most
    passing = np.zeros(1 << (power - 6), np.uint64)
    passing[np.asarray(held.column("word"))] = np.asarray(held.column("bits")).view(np.uint64)
    return passing


def _by_join(df: DataFrame, at: str, entries: DataFrame, text: str, out: str, fields: list[str], value: str) -> DataFrame:
    """`entries` have their anchors and lie `at` a path; what is met by the anchors of a block goes to the block."""
    spark = df.sparkSession
    some = F.least(F.octet_length(value), F.lit(len(_LEVEL_OF) - 1)).alias("n")
    with shuffles_dropped(spark):
        lengths = [r[0] for r in entries.select(some).where("n > 0").distinct().collect()]  # the lengths of _LEVEL_OF at most
        shared = spark.sparkContext.broadcast(_filter_over(entries))
    levels = np.unique(level_of(np.array(lengths, np.int64))).tolist() if lengths else []

    kept = [f for f in df.schema.fields if f.name != out]
    # A text that the answer stands in for is not kept.
    column, own = (text, []) if any(f.name == text for f in kept) else ("__text", [F.col(text).alias("__text")])
    _, texts = _saved(_in_blocks(df.select(*[F.col(f"`{f.name}`") for f in kept], *own), column), "texts")

    def given(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                rows, found = _unpacked(batch.slice(at, 1)).column(column), [np.zeros(0, np.uint64)]
                for begin in range(0, len(rows), _SLICE):
                    data, places = _bytes_of(rows.slice(begin, _SLICE))
                    found += [np.unique(hashes) for _, _, hashes in text_anchors(data, places, levels, shared.value)]
                anchors = np.unique(np.concatenate(found))
                blocks = np.full(len(anchors), batch.column("__block")[at].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(anchors.view(np.int64))], ["__block", "__anchor"])

    asked = texts.mapInArrow(given, "__block long, __anchor long")
    _, met = _saved(_by_block(asked.join(entries, "__anchor").select("__block", *fields)), "met")
    drop_dir(spark, at)
    schema = StructType([*kept, StructField(out, ArrayType(StructType([entries.schema[f] for f in fields])))])
    wanted = to_arrow_schema(schema)

    def one(packed: pa.Table, hits: pa.Table) -> pa.Table:
        table, held = _unpacked(packed), _unpacked(hits)
        if table is None:
            return wanted.empty_table()
        rows = table.select([f.name for f in kept])
        if held is None:
            none = pa.array([[]] * len(table), wanted.field(out).type)
            return pa.Table.from_arrays([*rows.columns, none], wanted.names)
        # Entries that come twice are one.
        held = held.group_by(fields, use_threads=False).aggregate([])
        held = held.take(pc.sort_indices(held, [(f, "ascending") for f in fields], null_placement="at_start"))
        struct = pa.StructArray.from_arrays([held.column(f).combine_chunks() for f in fields], fields)
        known = Anchored.of(held.column(value))
        values = struct.field(fields.index(value)).cast(pa.binary()).to_pylist()
        found = _matched(rows, table.column(column), known, struct, values, known.levels())
        return pa.concat_tables([pa.Table.from_arrays([*part.columns, hits], wanted.names) for part, hits in found])

    return texts.groupBy("__block").cogroup(met.groupBy("__block")).applyInArrow(one, schema)


def match_values(
    df: DataFrame,
    table: DataFrame,
    text: str,
    out: str,
    fields: list[str],
    value: str,
    key: str,
    max_bytes: int = MAX_BYTES,
    by_number: bool = False,
) -> DataFrame:
    """Add `out`: the entries (structs of `fields`, ascending by them) whose `value` occurs in the text.

    The first field is unique.  An entry without a value, or with an empty one, occurs nowhere, and a null text
    holds none.  The order of `out` is that of the first field.  Rows go by blocks of neighbours, so `key` decides nothing.
    `by_number`, entries have a number in their order in place of the first field, which takes less room than a long id.
    """
    spark = df.sparkSession
    ship_package(spark)
    # Saved first, as a gazetteer that is computed would be computed again for every step below.
    path, entries = _saved(_with_anchors(table.where(F.octet_length(value) > 0), fields, value, by_number), "anchors", "zstd")
    volume = entries.agg(F.sum(F.octet_length(F.to_json(F.struct(*fields))) + F.lit(48))).first()[0] or 0
    if volume > max_bytes:
        return _by_join(df, path, entries, text, out, fields, value)
    found = _in_place(df, entries, text, out, fields, value)
    drop_dir(spark, path)
    return found
