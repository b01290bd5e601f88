"""Token counts by overlap resynchronisation.

Texts up to ``window`` bytes are encoded whole, many in one library call.  A
longer text is encoded in windows that overlap by ``overlap`` bytes, with the
offsets of the pieces.  Two neighbouring encodings are spliced at a place
inside the overlap that is a piece boundary in both and that no piece of the
vocabulary can span (``pieces.proven``): left of it the first window's pieces
are those of the whole text, right of it the second's.  When an overlap holds
no such place it is doubled and the second window is encoded anew from further
left; when it would reach back over the window's own first splice, the first
window is instead encoded anew and further to the right.  The result is the
library's for every text; a task holds one window's pieces at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sensorlake.llm.common import slices, utf8
from sensorlake.llm.pieces import processor, proven

WINDOW = 1 << 15
OVERLAP = 256


def _back_to_character(data: bytes, at: int) -> int:
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _pieces(path: str, data: bytes, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """First bytes (in the whole text) and ids of the pieces of ``data[start:stop]``."""
    found = processor(path).encode(data[start:stop].decode(), return_type="proto").pieces
    begin = np.fromiter((p.begin for p in found), np.int64, len(found)) + start
    return begin, np.fromiter((p.id for p in found), np.int32, len(found))


def _splice(path: str, data: bytes, a: np.ndarray, b: np.ndarray, low: int, high: int) -> int | None:
    """A proven boundary of both encodings strictly between ``low`` and ``high``, the middlemost."""
    common = np.intersect1d(a, b)
    common = common[(common > low) & (common < high)]
    for at in sorted(common.tolist(), key=lambda x: abs(2 * x - low - high)):
        if proven(path, data, at):
            return at
    return None


def encode_resynchronised(path: str, text: bytes, window: int = WINDOW, overlap: int = OVERLAP) -> Iterator[tuple[np.ndarray, int]]:
    """Yields the token ids of ``text``, part by part, each with the number of times its overlap was widened."""
    n, start, left, widened = len(text), 0, 0, 0
    stop = _back_to_character(text, min(n, window))
    begin, ids = _pieces(path, text, start, stop)
    while stop < n:
        reach, at, again = overlap, None, 0
        while at is None:
            begin_at = _back_to_character(text, stop - reach)
            if begin_at <= left:  # nothing provable behind: take more text in front instead
                stop = _back_to_character(text, min(n, stop + max(window, stop - start)))
                begin, ids = _pieces(path, text, start, stop)
                reach, again = overlap, again + 1
                if stop >= n:
                    break
                continue
            end = _back_to_character(text, min(n, begin_at + max(window, 2 * reach)))
            begin2, ids2 = _pieces(path, text, begin_at, end)
            at = _splice(path, text, begin, begin2, begin_at, stop)
            if at is None:
                reach, again = 2 * reach, again + 1
        widened += again
        if at is None:
            break
        yield ids[(begin >= left) & (begin < at)] if left else ids[begin < at], again
        start, stop, left, begin, ids = begin_at, end, at, begin2, ids2
    yield ids[begin >= left] if left else ids, 0


def count_tokens(docs: DataFrame, path: str, text: str = "text", window: int = WINDOW, overlap: int = OVERLAP) -> DataFrame:
    """Every column of ``docs`` but ``text``, then ``n_tokens``, ``n_parts`` (spliced parts) and ``n_widened``.

    ``path``: a ``.model`` file that every worker can read.  Null counts as
    empty, which has no token and one part.  Repeated rows are counted each.
    An input column with one of the three names is replaced.
    """
    added = {"n_tokens": T.LongType(), "n_parts": T.LongType(), "n_widened": T.LongType()}
    kept = [c for c in docs.columns if c != text and c not in added]
    schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(k, t, False) for k, t in added.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(path)
        for whole in batches:
            for batch in slices(whole, text):
                texts = utf8(batch.column(text))
                counts = np.zeros((3, len(texts)), np.int64)
                short = [i for i, x in enumerate(texts) if len(x) <= window]
                counts[1] = 1
                counts[0, short] = [len(x) for x in sp.encode([texts[i].decode() for i in short], num_threads=1)]
                for i in set(range(len(texts))).difference(short):
                    parts = [(len(ids), again) for ids, again in encode_resynchronised(path, texts[i], window, overlap)]
                    counts[:, i] = sum(x for x, _ in parts), len(parts), sum(x for _, x in parts)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, counts)], names=[*kept, *added])

    return docs.select(*(docs[c] for c in [*kept, text])).mapInArrow(run, schema)
