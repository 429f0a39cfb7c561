"""Token-id files of independent zstandard frames with a seek table.

A file holds the documents of one range of ids, in order:

    frame ... frame | directory (skippable frame) | seek table (skippable frame)

Each frame is a complete zstandard frame over the ids of whole documents, as
little-endian unsigned 32-bit integers. The seek table is the one of the public
seekable format: for each frame its compressed size, its decompressed size and
the low 32 bits of the XXH64 of its content, then the number of frames, a
descriptor byte and a magic number. The directory holds the documents: id,
whether the id is null, frame, first id in the frame and number of ids. A
reader takes the two tables from the end of the file and decompresses only the
frames that hold the documents it is asked for.

Empty and null texts are documents of the end id alone; a null id comes before
all others; repeated ids stay apart, in any order. An empty table gives no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.common import Stored, map_batches, values
from textloom.llm.tokenizing import ID_BYTES, PieceEncoder
from textloom.sources.scratch import new_path

# Fixed values of the public seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
DIRECTORY_MAGIC = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 1 << 7

END_ID = 2
MOST_PIECES = 1_200_000  # pieces a task keeps; a larger table of them would double
_ENTRY = struct.Struct("<III")
_FOOTER = struct.Struct("<IBI")
_HEAD = struct.Struct("<II")
_PLACE = np.dtype([("id", "<i8"), ("null", "u1"), ("frame", "<u4"), ("at", "<u4"), ("n", "<u4")])
FILES = "file string, part int, docs long, n_ids long"
ROWS = "part int, place long, doc_id long, n_tokens long, ids_crc32 long, ids binary"


class FrameWriter:
    """Writes one file to an open binary stream."""

    def __init__(self, out, frame_ids: int, level: int = 1):
        import zstandard

        self.out, self.frame_ids = out, frame_ids
        self.packer = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.waiting: list[bytes] = []
        self.waiting_ids = 0
        self.frames: list[tuple[int, int, int]] = []
        self.places: list[np.ndarray] = []
        self.open_places: list[tuple] = []
        self.docs = self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // ID_BYTES
        self.open_places.append((doc_id or 0, doc_id is None, len(self.frames), self.waiting_ids, n))
        self.waiting.append(ids)
        self.waiting_ids += n
        self.docs += 1
        self.n_ids += n
        if self.waiting_ids >= self.frame_ids:
            self._end_frame()

    def _end_frame(self) -> None:
        import xxhash

        content = b"".join(self.waiting)
        packed = self.packer.compress(content)
        self.out.write(packed)
        self.frames.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.places.append(np.array(self.open_places, dtype=_PLACE))
        self.waiting, self.open_places, self.waiting_ids = [], [], 0

    def finish(self) -> None:
        if self.waiting:
            self._end_frame()
        directory = b"".join(p.tobytes() for p in self.places) + struct.pack("<Q", self.docs)
        self.out.write(_HEAD.pack(DIRECTORY_MAGIC, len(directory)) + directory)
        table = b"".join(_ENTRY.pack(*f) for f in self.frames) + _FOOTER.pack(
            len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC
        )
        self.out.write(_HEAD.pack(SKIPPABLE_MAGIC, len(table)) + table)


class FrameReader:
    """Reads documents from an open random-access file, one frame at a time."""

    def __init__(self, source):
        import zstandard

        self.source = source
        self.unpacker = zstandard.ZstdDecompressor()
        size = source.size()
        n_frames, _, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a seekable token file")
        table = size - _FOOTER.size - n_frames * _ENTRY.size
        entries = np.frombuffer(self._at(table, n_frames * _ENTRY.size), "<u4").reshape(-1, 3)
        self.packed, self.size, self.checksum = entries.T.astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.packed)])
        end = table - _HEAD.size
        (docs,) = struct.unpack("<Q", self._at(end - 8, 8))
        self.places = np.frombuffer(self._at(end - 8 - docs * _PLACE.itemsize, docs * _PLACE.itemsize), _PLACE)

    def _at(self, start: int, n: int) -> bytes:
        self.source.seek(int(start))
        return self.source.read(int(n))

    def frame(self, k: int) -> bytes:
        import xxhash

        content = self.unpacker.decompress(self._at(self.starts[k], self.packed[k]), max_output_size=int(self.size[k]))
        if len(content) != self.size[k] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.checksum[k]:
            raise ValueError(f"frame {k} does not match its checksum")
        return content

    def documents(self, wanted: Sequence[int] | None = None) -> Iterator[tuple[int, int | None, bytes]]:
        """`(place, doc_id, ids)` of all documents, or of those with a wanted id."""
        chosen = np.arange(len(self.places))
        if wanted is not None:
            chosen = np.flatnonzero(np.isin(self.places["id"], list(wanted)) & (self.places["null"] == 0))
        held, content = -1, b""
        for place in chosen:
            row = self.places[place]
            if row["frame"] != held:
                held = int(row["frame"])
                content = self.frame(held)
            start = int(row["at"]) * ID_BYTES
            doc_id = None if row["null"] else int(row["id"])
            yield int(place), doc_id, content[start : start + int(row["n"]) * ID_BYTES]


def open_store(path: str):
    """The file system of a path and the path in it; a scheme such as hdfs: or s3: is followed."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, files: int, end_id: int = END_ID, frame_ids: int = 1 << 18
) -> Stored:
    """Write `docs(doc_id, text)` to about `files` files in `folder`, in ascending order of id.

    Returns the table of the files, stored. Texts are range-partitioned by id and
    sorted; each task streams one partition to one file, holding one frame at a
    time. A task writes under a name of its own and renames at the end, so a
    task that is run again after a lost executor leaves one whole file.
    """
    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id")
    )
    return Stored(map_batches(ranged, _write, FILES, folder=folder, path=tokenizer, end_id=end_id, frame_ids=frame_ids), "files")


def _write(batches, folder, path, end_id, frame_ids):
    from pyspark import TaskContext

    store, root = open_store(folder)
    context = TaskContext.get()
    part = context.partitionId()
    end = int(end_id).to_bytes(ID_BYTES, "little")
    own, final = f"{root}/.part-{part:06d}-{context.taskAttemptId()}", f"{root}/part-{part:06d}.tokens"
    known, writer, out = PieceEncoder(path, MOST_PIECES), None, None
    for batch in batches:
        texts = [text or "" for text in values(batch, "text")]
        for doc_id, ids in zip(values(batch, "doc_id"), known.encode(texts)):
            if writer is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(own)
                writer = FrameWriter(out, frame_ids)
            writer.add(doc_id, ids + end)
    if writer is not None:
        writer.finish()
        out.close()
        store.move(own, final)
        yield {"file": [f"{folder}/part-{part:06d}.tokens"], "part": [part], "docs": [writer.docs], "n_ids": [writer.n_ids]}


def read_token_files(
    spark: SparkSession, files: DataFrame, wanted: Sequence[int] | None = None, with_ids: bool = True
) -> DataFrame:
    """Documents of the files: part, place in it, id, number of ids, their CRC-32, and the ids."""
    n = max(1, files.count())  # one row for each file: its size is checked by counting it
    spread = files.select("file", "part").repartition(n, "part")
    wanted = None if wanted is None else [int(i) for i in wanted]
    return map_batches(spread, _read, ROWS, wanted=wanted, with_ids=with_ids)


def _read(batches, wanted, with_ids):
    names = ("part", "place", "doc_id", "n_tokens", "ids_crc32", "ids")
    for batch in batches:
        for file, part in zip(values(batch, "file"), values(batch, "part")):
            store, path = open_store(file)
            rows, held = [], 0
            with store.open_input_file(path) as source:
                for place, doc_id, ids in FrameReader(source).documents(wanted):
                    rows.append((part, place, doc_id, len(ids) // ID_BYTES, zlib.crc32(ids), ids if with_ids else None))
                    held += len(ids) if with_ids else 40
                    if held > 16 << 20:
                        yield dict(zip(names, zip(*rows)))
                        rows, held = [], 0
            if rows:
                yield dict(zip(names, zip(*rows)))


def with_starts(documents: DataFrame, files: DataFrame) -> DataFrame:
    """Add `start`, the number of ids of all documents before: inside a file, then over the files.

    The second sum is over one row for each file.
    """
    over_files = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("part", F.coalesce(F.sum("n_ids").over(over_files), F.lit(0)).alias("__before"))
    in_file = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    inside = documents.withColumn("__inside", F.coalesce(F.sum("n_tokens").over(in_file), F.lit(0)))
    return inside.join(before, "part").withColumn("start", F.col("__before") + F.col("__inside")).drop("__before", "__inside")


def token_file_round_trip(docs: DataFrame, tokenizer: str, files: int) -> DataFrame:
    """Write the documents to files in the shared folder and read every one back."""
    spark = docs.sparkSession
    written = write_token_files(docs, new_path(spark, "tokens"), tokenizer, files)
    found = read_token_files(spark, written.df, with_ids=False)
    return with_starts(found, written.df)
