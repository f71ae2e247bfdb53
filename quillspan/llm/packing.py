"""Best-fit packing: documents become sequences of a fixed number of tokens.

Bounded-space online best-fit. Each packing task keeps a fixed number of open bins in a bitset keyed by
free space; a piece goes to the open bin that it fills best, and the fullest bin closes when no bin fits
and all places are taken. Token ids are made once, in the scan of the texts; only lengths are packed.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ceil_div, released, slices, written

CAPACITY = 4096
#: Open bins of a packing task. More bins pack tighter and take more memory.
OPEN_BINS = 1024
#: Pieces that one packing task gets on average.
PIECES_PER_TASK = 100_000
#: Entries of each of a worker's two token caches; beyond that they start anew.
CACHE_ENTRIES = 250_000
END_ID = 1

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# How the vocabulary's pre-tokenizer cuts a lower-cased word, for letters up to U+00FF.
_LATIN_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿªµº]+|[0-9²³¹¼½¾]|[^a-zß-öø-ÿªµº0-9²³¹¼½¾]+")
_SIMPLE_WORD = re.compile(r"[!-~¡-¬®-ÿ]+")


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit integers, exactly as the tokenizer gives them.

    Words apart by ASCII white space are tokenized on their own, which this kind of vocabulary allows: its
    pre-tokenizer drops white space and never joins across it. Words and the pieces that the pre-tokenizer
    cuts them to are cached. Words with characters above U+00FF, or that could hold a special token, go to
    the tokenizer itself.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.entries = entries
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.bytes = _byte_letters()

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else "".join(map(self.bytes.__getitem__, piece.encode()))
        out = b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(letters))
        if len(self.pieces) >= self.entries:
            self.pieces.clear()
        self.pieces[piece] = out
        return out

    def _word(self, word: str) -> bytes:
        if _SIMPLE_WORD.fullmatch(word) and "<|" not in word:
            known = self.pieces
            out = b"".join([known.get(p) or self._piece(p) for p in _LATIN_PIECE.findall(word.lower())])
        else:
            out = b"".join(i.to_bytes(4, "little") for i in self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(self.words) >= self.entries:
            self.words.clear()
        self.words[word] = out
        return out

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        for c in "\t\n\x0b\x0c\r":
            if c in text:
                text = text.replace(c, " ")
        known, parts = self.words, text.split(" ")
        try:
            return b"".join(map(known.__getitem__, parts))
        except KeyError:
            out = []
            for p in parts:
                ids = known.get(p)
                out.append(self._word(p) if ids is None else ids)
            return b"".join(out)

    def clear(self) -> None:
        self.words.clear()
        self.pieces.clear()


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 as it is, the rest from U+0100 on."""
    out, more = [], 256
    for b in range(256):
        plain = 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255
        out.append(chr(b) if plain else chr(more))
        more += not plain
    return out


_worker_ids: dict[str, Ids] = {}  # kept between the tasks of a Python worker, but for the caches


def worker_ids(path: str) -> Ids:
    if path not in _worker_ids:
        _worker_ids[path] = Ids(path)
    return _worker_ids[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and the end id, cut where longer than capacity.

    A null or empty text is the end id alone. Repeated rows are packed as often as they stand there.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = worker_ids(tokenizer)
        end, step = END_ID.to_bytes(4, "little"), 4 * capacity
        try:
            for batch in slices(batches):
                rows: list[tuple] = []
                for doc_id, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                    data = ids(text) + end
                    for k, at in enumerate(range(0, len(data), step)):
                        part = data[at : at + step]
                        rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        finally:
            ids.clear()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _PIECES)


class OpenBins:
    """At most `most` open bins, each with the number of its sequence and its fill; the bitset has a bit for each free space in use."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.open, self.made = capacity, most, 0, 0
        self.bits = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        at = self.by_free[free]
        bin_ = at.pop()
        if not at:
            self.bits &= ~(1 << free)
        self.open -= 1
        return bin_

    def put(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it for a piece of this length. A piece of a bin's whole size needs no open bin."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.open == self.most and length < self.capacity:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            bin_, free = self.made, self.capacity
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
        return bin_, self.capacity - free


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """The pieces with sequence_id and offset.

    Pieces are dealt to tasks by a hash of all that they hold, so a task's load doesn't depend on any key,
    and each task packs its pieces in the order of that hash. Full pieces are sequences of their own. What is
    still open at the end of a task stays a sequence: at most open_bins of them for per_task pieces.
    """
    pieces = written(pieces, "pieces")
    tasks = max(1, ceil_div(pieces.count(), per_task))
    dealt = F.xxhash64("doc_id", "piece", "ids_crc32", "length")
    keyed = pieces.withColumn("__h", dealt).withColumn("__task", F.pmod("__h", F.lit(tasks)))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins: dict[int, OpenBins] = {}
        for batch in batches:
            seq, offset = [], []
            for task, length in zip(batch["__task"].to_pylist(), batch["length"].to_pylist(), strict=True):
                if task not in bins:
                    bins.clear()  # rows come sorted by task
                    bins[task] = OpenBins(capacity, open_bins)
                bin_, at = bins[task].put(length)
                seq.append(bin_ * tasks + task)
                offset.append(at)
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")] + [pa.array(seq, pa.int64()), pa.array(offset, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return (
        keyed.repartition(tasks, "__task")
        .sortWithinPartitions("__task", "__h", "doc_id", "piece")
        .mapInArrow(run, f"{_PIECES}, sequence_id long, offset long")
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Packs all documents; one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null doc_id: packed like any other. Null or empty text: the end id alone. Empty table: no rows. Extra
    columns are ignored. Very long texts are cut to full pieces and one last piece. Ties and repeated rows: each is packed.
    """
    return pack(token_pieces(docs, tokenizer, capacity), capacity, open_bins)
