"""Fill-in-the-middle transformation with SWAR words over UTF-8.

The texts of a batch lie one after another in one buffer, read as little-endian 64-bit words of eight bytes each. A
byte starts a code point unless its two highest bits are 10; two shifts and a mask tell that for all eight bytes of a
word, and a byte ends a unit where the next one starts a unit (the last byte of a text always ends one). The marks of a
word are counted with one population count, and running sums over words give the rank of any byte. To cut after the
k-th unit, the word is found by binary search in the running sums and the byte inside it by one multiplication (running
counts of all eight bytes) and one subtraction that compares them all with the wanted rank.

The text up to the first cut is the prefix, up to the second the middle, the rest the suffix. A row is written

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle
    plain  the text itself

Cuts and form come from the SHA-256 of a seed and the row's id, so a rerun agrees on any split of the input. A text
that holds one of the three marks stays plain, so the marks of the other forms can only be those written here and
``restored`` gives the exact text back.

Null texts count as empty and are plain; a null id counts as an empty string in the hash; rows with an equal id are cut
by the same numbers; a text of any length takes some four times its bytes in one task; in bytes that are not UTF-8,
a unit reaches up to the next byte that can start one, and all bytes are kept; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_EACH = np.uint64(0x0101010101010101)  # one in every byte
_TOP = np.uint64(0x8080808080808080)
_EIGHT = np.uint64(8)
GROUP_BYTES = 4 << 20


class Units:
    """Rank and select over the unit ends of texts that lie at ``offsets`` in one buffer."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        n = int(offsets[-1] - offsets[0])
        padded = np.zeros((n // 8 + 2) * 8, np.uint8)
        padded[:n] = raw[offsets[0] : offsets[-1]]
        words = padded.view("<u8")
        starts = ~((words >> np.uint64(7)) & ~(words >> np.uint64(6))) & _EACH
        ends = starts >> _EIGHT
        ends[:-1] |= (starts[1:] & np.uint64(1)) << np.uint64(56)
        last = (offsets[1:] - offsets[0])[np.diff(offsets) > 0] - 1
        np.bitwise_or.at(ends, last >> 3, np.uint64(1) << (last & 7).astype(np.uint64) * _EIGHT)
        self.ends = ends
        self.before = np.zeros(len(ends) + 1, np.int64)
        np.cumsum(np.bitwise_count(ends), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Units that end before byte ``at``."""
        word = at >> 3
        below = (np.uint64(1) << (at & 7).astype(np.uint64) * _EIGHT) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.ends[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte after the end of unit ``k``, counted from one; the start for unit zero."""
        word = np.maximum(np.searchsorted(self.before, k, side="left") - 1, 0)
        wanted = (k - self.before[word]).astype(np.uint64)
        counts = self.ends[word] * _EACH  # byte j: ends among bytes 0 to j
        reached = ((counts | _TOP) - wanted * _EACH) & _TOP
        return np.where(k > 0, 8 * word + 9 - np.bitwise_count(reached), 0)


def _cut_group(raw: memoryview, offsets: np.ndarray, h: np.ndarray, forms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    units = Units(np.frombuffer(raw, np.uint8), offsets)
    start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    first = units.rank(start)
    n = units.rank(end) - first
    cuts = np.sort(h % (n[:, None] + 1), axis=1)
    places = np.where(cuts > 0, units.select(first[:, None] + cuts), start[:, None]) + offsets[0]
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    out = []
    for form, a, (b, c), d in zip(forms, offsets[:-1].tolist(), places.tolist(), offsets[1:].tolist(), strict=True):
        if form == "psm":
            out.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
        elif form == "spm":
            out.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
        else:
            out.append(bytes(raw[a:d]))
    return n, cuts[:, 0], cuts[:, 1] - cuts[:, 0], out


def _text_buffer(texts: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of a string column and the offsets of its texts in them."""
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return memoryview(data) if data is not None else memoryview(b""), at


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, cut_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): of a hundred rows about ``cut_percent`` are cut, and of
    these ``spm_percent`` of a hundred are written suffix first."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            raw, at = _text_buffer(b["text"])
            h = np.stack([b[c].to_numpy() for c in ("h1", "h2")], axis=1)
            forms = b["form"].to_pylist()
            # groups of some megabytes, a longer text by itself
            group = (at[1:] - at[0] - 1) // GROUP_BYTES
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), b.num_rows]
            for i, j in zip(edges[:-1], edges[1:]):
                n, prefix, middle, out = _cut_group(raw, at[i : j + 1], h[i:j], forms[i:j])
                plain = np.array([f == "plain" for f in forms[i:j]])
                yield pa.RecordBatch.from_arrays(
                    [
                        b["doc_id"][i:j],
                        pa.array(n, pa.int64()),
                        b["form"][i:j],
                        pa.array(prefix, pa.int64(), mask=plain),
                        pa.array(middle, pa.int64(), mask=plain),
                        pa.array(out, pa.binary()).view(pa.string()),
                    ],
                    names=names,
                )

    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)

    def h(i: int) -> Column:
        return F.conv(F.substring(digest, 8 * i - 7, 8), 16, 10).cast("long")

    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (h(3) % 100 >= cut_percent)
    form = F.when(plain, "plain").when(h(4) % 100 < spm_percent, "spm").otherwise("psm")
    ready = src.select("doc_id", "text", h(1).alias("h1"), h(2).alias("h2"), form.alias("form"))
    return ready.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""
    first, second = F.split_part(output, F.lit(SUFFIX), F.lit(1)), F.split_part(output, F.lit(SUFFIX), F.lit(2))
    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(F.split_part(first, F.lit(PREFIX), F.lit(2)), middle, F.split_part(second, F.lit(MIDDLE), F.lit(1)))
    front = F.split_part(F.split_part(output, F.lit(PREFIX), F.lit(2)), F.lit(MIDDLE), F.lit(1))
    spm = F.concat(front, middle, F.split_part(second, F.lit(PREFIX), F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
