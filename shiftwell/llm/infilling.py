"""Fill-in-the-middle over texts stored as independent compressed frames."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwell.llm.groups import slices
from shiftwell.llm.tables import written
from shiftwell.llm.workers import kept

FRAME_BYTES = 1 << 18
LEVEL = 3
RATE = 100
SPM = 50
SEED = 7
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

# What a frame holds and, for the cuts, all frames up to and with it.
FRAME = "struct<bytes: int, lines: bigint, chars: bigint, data: binary>"


class Frame(NamedTuple):
    """Bytes of a text, compressed on their own; lines and chars up to its end."""

    bytes: int
    lines: int
    chars: int
    data: bytes


def n_chars(data: bytes) -> int:
    """Code points: bytes that do not continue one."""
    values = np.frombuffer(data, dtype=np.uint8)
    return len(values) - int(np.count_nonzero((values & 0xC0) == 0x80))


def compressed(data: bytes) -> bytes:
    return kept(("zstd", LEVEL), lambda: zstandard.ZstdCompressor(level=LEVEL)).compress(data)


def plain(frame: Frame) -> bytes:
    make = kept("unzstd", zstandard.ZstdDecompressor)
    return make.decompress(frame.data, max_output_size=max(frame.bytes, 1))


def cut(text: bytes, size: int = FRAME_BYTES) -> list[Frame]:
    """A text as frames of ``size`` bytes; an empty one has none."""
    frames, lines, chars = [], 0, 0
    for start in range(0, len(text), size):
        part = text[start : start + size]
        lines, chars = lines + part.count(b"\n"), chars + n_chars(part)
        frames.append(Frame(len(part), lines, chars, compressed(part)))
    return frames


class Sides(NamedTuple):
    """Frames before and behind a place of the text, and the characters before it."""

    before: list[Frame]
    behind: list[Frame]
    chars: int


def split_after(frames: list[Frame], lines: int) -> Sides:
    """The frames in two, after so many lines; only the frame that is cut is read.

    Lines beyond the last line end are the text's last line, which has none.
    """
    if not frames or not lines:
        return Sides([], frames, 0)
    ends = [frame.lines for frame in frames]
    at = int(np.searchsorted(ends, lines))
    if at == len(frames):
        return Sides(frames, [], frames[-1].chars)
    earlier = ends[at - 1] if at else 0
    data, place = plain(frames[at]), 0
    for _ in range(lines - earlier):
        place = data.index(b"\n", place) + 1
    chars = (frames[at - 1].chars if at else 0) + n_chars(data[:place])
    whole = frames[at]
    head = Frame(place, lines, chars, compressed(data[:place]))
    rest = Frame(whole.bytes - place, whole.lines, whole.chars, compressed(data[place:]))
    return Sides(
        [*frames[:at], head], [*([rest] if rest.bytes else []), *frames[at + 1 :]], chars
    )


def n_lines(frames: list[Frame]) -> int:
    """Lines of the text, a last one without a line end included."""
    if not frames:
        return 0
    return frames[-1].lines + (not plain(frames[-1]).endswith(b"\n"))


def holds_sentinel(frames: list[Frame]) -> bool:
    """Whether one of the three marks is in the text, over the ends of frames too."""
    tail = b""
    for frame in frames:
        data = tail + plain(frame)
        if PREFIX in data or SUFFIX in data or MIDDLE in data:
            return True
        tail = data[-2:]
    return False


def hashes(seed: int, key: int | None) -> list[int]:
    """The first four groups of eight hex digits of the sha256 of ``seed:key``."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[start : start + 8], 16) for start in range(0, 32, 8)]


def digest(frames: Iterable[Frame]) -> str:
    found = hashlib.sha256()
    for frame in frames:
        found.update(plain(frame))
    return found.hexdigest()


def restored(output: list[Frame], form: str) -> Iterator[bytes]:
    """The text that an output was made of, in pieces, from the output and its form.

    The marks are looked for in the output itself, frame by frame. What lies between
    the first and the second mark of spm is the suffix, which comes last: its frames
    are read again at the end rather than held.
    """
    if form == "plain":
        yield from map(plain, output)
        return
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    starts = _mark_places(output, order)
    ends = [*starts[1:], sum(frame.bytes for frame in output)]
    spans = {
        mark: (start + len(mark), end) for mark, start, end in zip(order, starts, ends, strict=True)
    }
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from _span(output, *spans[mark])


def _mark_places(output: list[Frame], order: tuple[bytes, ...]) -> list[int]:
    """Where each mark starts; a mark may lie over the end of a frame."""
    places, base, tail = [], 0, b""
    for frame in output:
        data = tail + plain(frame)
        base -= len(tail)
        start = 0
        while len(places) < len(order):
            at = data.find(order[len(places)], start)
            if at < 0:
                break
            places.append(base + at)
            start = at + 3
        base += len(data)
        tail = data[max(start, len(data) - 2) :]
    return places


def _span(frames: list[Frame], start: int, end: int) -> Iterator[bytes]:
    """The bytes from ``start`` to ``end``; frames outside are not decompressed."""
    at = 0
    for frame in frames:
        if at < end and at + frame.bytes > start:
            yield plain(frame)[max(0, start - at) : end - at]
        at += frame.bytes


class Infilled(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: list[Frame]


def infilled(frames: list[Frame], key: int | None, rate: int, spm: int, seed: int) -> Infilled:
    """A text's output as frames: those inside its parts as they are, the cut ones new."""
    n = n_lines(frames)
    one, two, three, four = hashes(seed, key)
    if not frames or three % 100 >= rate or holds_sentinel(frames):
        return Infilled(n, "plain", None, None, frames)
    low, high = sorted((one % (n + 1), two % (n + 1)))
    last = split_after(frames, high)
    first = split_after(last.before, low)
    prefix, middle, suffix = first.before, first.behind, last.behind
    mark = {m: Frame(len(m), 0, len(m), compressed(m)) for m in (PREFIX, SUFFIX, MIDDLE)}
    if four % 100 < spm:
        form, output = "spm", [mark[SUFFIX], *suffix, mark[PREFIX], *prefix, mark[MIDDLE], *middle]
    else:
        form, output = "psm", [mark[PREFIX], *prefix, mark[SUFFIX], *suffix, mark[MIDDLE], *middle]
    return Infilled(n, form, first.chars, last.chars - first.chars, output)


# --- over tables -------------------------------------------------------------------


def _framing(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            frames = [
                [frame._asdict() for frame in cut(text.as_py(), size)] for text in batch["text"]
            ]
            kind = pa.list_(
                pa.struct(
                    [
                        ("bytes", pa.int32()),
                        ("lines", pa.int64()),
                        ("chars", pa.int64()),
                        ("data", pa.binary()),
                    ]
                )
            )
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array(frames, kind)], names=["key", "frames"]
            )

    return task


def framed(
    documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = FRAME_BYTES
) -> DataFrame:
    """key and frames: each text as frames that can be decompressed one by one.

    A frame has its bytes and, with all before it, line ends and characters, so the
    frame that holds a line is found without reading any. NULL and empty texts have no
    frames.
    """
    read = documents.select(
        F.col(key).cast("bigint").alias("key"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    return read.mapInArrow(_framing(size), f"key bigint, frames array<{FRAME}>").withColumnRenamed(
        "key", key
    )


def store_frames(frames: DataFrame, path: str) -> DataFrame:
    """The frames as a table at ``path``, read from there.

    The frames are compressed already, so the table is not once more.
    """
    frames.write.option("compression", "none").parquet(path)
    return load_frames(frames.sparkSession, path, frames.schema)


def load_frames(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _frames(values: list[dict]) -> list[Frame]:
    return [Frame(v["bytes"], v["lines"], v["chars"], v["data"]) for v in values]


RESULT = (
    "key bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
    "output_sha256 string, restored_sha256 string"
)


def _infilling(rate: int, spm: int, seed: int, outputs: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            rows = []
            for key, values in zip(batch["key"], batch["frames"]):
                made = infilled(_frames(values.as_py()), key.as_py(), rate, spm, seed)
                whole = hashlib.sha256()
                for part in restored(made.output, made.form):
                    whole.update(part)
                row = {
                    "key": key.as_py(),
                    "n": made.n,
                    "form": made.form,
                    "prefix_chars": made.prefix_chars,
                    "middle_chars": made.middle_chars,
                    "output_sha256": digest(made.output),
                    "restored_sha256": whole.hexdigest(),
                }
                if outputs:
                    row["output"] = [frame.data for frame in made.output]
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow(outputs))

    return task


def _arrow(outputs: bool) -> pa.Schema:
    whole, text = pa.int64(), pa.string()
    fields = [("key", whole), ("n", whole), ("form", text), ("prefix_chars", whole)]
    fields += [("middle_chars", whole), ("output_sha256", text), ("restored_sha256", text)]
    return pa.schema(fields + ([("output", pa.list_(pa.binary()))] if outputs else []))


def fill_in_middle(
    frames: DataFrame,
    key: str = "doc_id",
    rate: int = RATE,
    spm: int = SPM,
    seed: int = SEED,
    outputs: bool = True,
) -> DataFrame:
    """Each framed text cut into prefix, middle and suffix and put into a form.

    Columns: key, n (lines), form (psm, spm or plain), prefix_chars, middle_chars,
    output_sha256, restored_sha256 and, with ``outputs``, output: the zstandard frames
    of the transformed text, in order. The cuts, the form and whether a text is
    transformed at all (``rate`` of 100) follow from the seed and the key alone.

    Only frames that hold a cut are taken apart: the others go into the output as they
    are. The digests stream the frames in order, that of the restored text from the
    output itself, so a task holds one plain frame at a time besides a row's compressed
    ones. No row meets another and nothing is shuffled.

    Empty texts and texts that hold a mark are plain: prefix_chars and middle_chars
    are NULL and the output is the text. A NULL key is hashed as an empty one.
    """
    task = _infilling(rate, spm, seed, outputs)
    kind = RESULT + (", output array<binary>" if outputs else "")
    read = frames.select(F.col(key).alias("key"), "frames")
    return read.mapInArrow(task, kind).withColumnRenamed("key", key)


def output_texts(rows: DataFrame, output: str = "output") -> DataFrame:
    """The rows with their output as text, ``output_text``, and without its frames.

    Made for training files; a text is in memory as a whole here.
    """

    @F.pandas_udf("binary")
    def joined(column):
        def text(frames) -> bytes:
            make = kept("unzstd", zstandard.ZstdDecompressor)
            return b"".join(make.decompressobj().decompress(bytes(frame)) for frame in frames)

        return column.map(text)

    columns = [name for name in rows.columns if name not in (output, "output_text")]
    return rows.select(*columns, joined(output).cast("string").alias("output_text"))


def transformed(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rate: int = RATE,
    spm: int = SPM,
    seed: int = SEED,
    size: int = FRAME_BYTES,
    outputs: bool = True,
) -> DataFrame:
    """``fill_in_middle`` of documents, whose frames are written to scratch first.

    Whole texts of any length are taken. NULL texts count as empty. Repeated rows keep
    their place, an empty table gives an empty result, further columns are not read.
    """
    stored = written(framed(documents, key, text, size), "text-frames")
    return fill_in_middle(stored, key, rate, spm, seed, outputs)
