"""Counting of chosen phrases in texts, as numpy and Arrow work over buffers of one language (for use inside tasks).

Texts of a language are joined into one buffer with a cut between them.  Words get exact numbers by Arrow's dictionary;
phrases are told apart by folding those numbers, so a count never rests on a hash.  Which phrases are looked at is decided
by bitmaps of phrase hashes: a false hit only means that a phrase is counted that nobody asked for.

A buffer is cut into words once.  Its frequent words are kept as numbers, which all passes over the texts count from."""

from __future__ import annotations

import numpy as np
import xxhash

#: Texts of all languages that are held before they are counted.
BUFFER = 6 << 20
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27

_WORD, _CUT = 0, 2
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _CUT
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def buffers(batches):
    """(lang, bytes) of Arrow batches with the columns lang and text: texts of one language, a line end between them."""
    held, size = {}, 0
    for batch in batches:
        texts = batch.column(1).cast("binary").to_pylist()
        for lang, text in zip(batch.column(0).to_pylist(), texts):
            if text:
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= BUFFER:
                    yield from ((k, b"\n".join(v)) for k, v in held.items())
                    held, size = {}, 0
    yield from ((k, b"\n".join(v)) for k, v in held.items())


def mixed(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its words but the last and that of the last."""
    x = prefix * np.uint64(0x9E3779B97F4A7C15) + word
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    key, seed = xxhash.xxh3_64_intdigest, xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.array([key(w, seed) for w in words], np.uint64)


def phrase_hash(lang: str, phrase: str) -> int:
    h = word_hashes(lang, phrase.encode("utf-8", "surrogatepass").split(b" "))
    out = h[:1]
    for k in range(1, len(h)):
        out = mixed(out, h[k:k + 1])
    return int(out[0])


def held_in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


class Words:
    """The words of a buffer: their numbers, and whether the next word lies in the same piece."""

    def __init__(self, lang: str, text: bytes):
        import pyarrow as pa
        data = LOWER[np.frombuffer(text, np.uint8)]
        kind = KIND[data]
        word = kind == _WORD
        edge = np.diff(np.r_[False, word, False].view(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
        flat = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[word])])
        coded = flat.dictionary_encode()
        self.lang, self.names = lang, coded.dictionary
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.cumsum(kind == _CUT, dtype=np.int32)[starts]
        self.joined = cuts[1:] == cuts[:-1]  # words k and k + 1 lie in one piece

    @property
    def hashes(self) -> np.ndarray:
        return word_hashes(self.lang, self.names.to_pylist())

    def numbered(self, common: np.ndarray) -> tuple[bytes, bytes]:
        """The different words in the bitmap ``common``, blanks between them, and where they stand: a 32-bit number for
        each, its lowest bit set if the next word is kept and lies in the same piece.  Words without such a neighbour go."""
        there = held_in(common, self.hashes)
        kept = there[self.ids]
        run = self.joined & kept[1:] & kept[:-1]
        left = np.flatnonzero(np.r_[run, False][:len(kept)] | np.r_[False, run][:len(kept)])
        used = np.zeros(len(there), bool)
        used[self.ids[left]] = True
        codes = (np.cumsum(used) - 1)[self.ids[left]] << 1 | np.r_[run, False][left]
        return b" ".join(np.array(self.names.to_pylist(), object)[used]), codes.astype("<u4").tobytes()

    @classmethod
    def of_numbers(cls, lang: str, names: bytes, codes: bytes) -> Words:
        """What ``numbered`` kept.  No word is joined to one left out: a word before every occurrence of a frequent phrase
        is frequent itself."""
        import pyarrow as pa
        w, codes = cls.__new__(cls), np.frombuffer(codes, "<u4").astype(np.int64)
        w.lang, w.names = lang, pa.array(names.split(b" ") if names else [], pa.binary())
        w.ids, w.joined = codes >> 1, (codes[:-1] & 1).astype(bool)
        return w


def batch_of(lang: str, phrases, counts, least, most):
    import pyarrow as pa
    n = len(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int64))), phrases.cast(pa.string()), pa.array(counts, pa.int64()),
         pa.array(least, pa.int64()), pa.array(most, pa.int64())], ["lang", "phrase", "a", "least", "most"])


def counted_words(batches):
    """Every word with its count in a buffer, and under the empty phrase the count of all."""
    import pyarrow as pa
    for lang, text in buffers(batches):
        w = Words(lang, text)
        n = len(w.ids)
        if n:
            names = pa.concat_arrays([w.names, pa.array([b""], pa.binary())])
            counts = np.r_[np.bincount(w.ids, minlength=len(w.names)), n]
            yield batch_of(lang, names, counts, np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64))


def numbered_words(batches, common: np.ndarray):
    """(lang, names, codes) of every buffer: its words in the bitmap ``common`` as numbers (see ``Words.numbered``)."""
    import pyarrow as pa
    for lang, text in buffers(batches):
        names, codes = Words(lang, text).numbered(common)
        if codes:
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([names], pa.binary()), pa.array([codes], pa.binary())],
                                             ["lang", "names", "codes"])


def counted_numbers(batches, chain: np.ndarray, common: np.ndarray | None, lengths: range):
    """``counted_phrases`` of what ``numbered_words`` kept."""
    for batch in batches:
        for row in range(batch.num_rows):
            w = Words.of_numbers(*(c[row].as_py() for c in batch.columns))
            yield from _phrases(w, chain, common, lengths)


def counted_phrases(batches, chain: np.ndarray, common: np.ndarray | None, lengths: range):
    """Phrases with their count in a buffer and the least and greatest hash of the word before them (0: none).

    A phrase of a length in ``lengths`` is counted if its words but the last, and each phrase that these begin with, are in
    ``chain``, and its last word is in ``common``; without ``common``, if the phrase itself is in ``chain``."""
    for lang, text in buffers(batches):
        yield from _phrases(Words(lang, text), chain, common, lengths)


def _phrases(w: Words, chain: np.ndarray, common: np.ndarray | None, lengths: range):
    if len(w.ids) < 2:
        return
    hashes = w.hashes
    at = np.flatnonzero(held_in(chain, hashes)[w.ids])  # where phrases start
    last = np.ones(len(hashes), bool) if common is None else held_in(common, hashes)
    before = np.zeros(len(w.ids), np.int64)
    before[1:][w.joined] = (hashes | np.uint64(1)).view(np.int64)[w.ids[:-1][w.joined]]
    value = hashes[w.ids[at]]
    for size in range(2, lengths.stop):
        more = at + size - 1 < len(w.ids)
        more[more] = w.joined[at[more] + size - 2] & last[w.ids[at[more] + size - 1]]
        at, value = at[more], value[more]
        value = mixed(value, hashes[w.ids[at + size - 1]])
        if common is None:
            there = held_in(chain, value)
            at, value = at[there], value[there]
        if not len(at):
            break
        if size in lengths:
            yield grouped(w, at, size, before[at])
        if common is not None:
            there = held_in(chain, value)
            at, value = at[there], value[there]


def grouped(w: Words, at: np.ndarray, size: int, before: np.ndarray):
    """The phrases of ``size`` words that start at ``at``, each once."""
    import pyarrow as pa
    import pyarrow.compute as pc
    code, names = w.ids[at], np.int64(len(w.names))
    for k in range(1, size):
        code = pa.array(code * names + w.ids[at + k]).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.bincount(code)
    first = np.zeros(len(counts), np.int64)
    first[code[::-1]] = at[::-1]
    least, most = np.full(len(counts), np.iinfo(np.int64).max), np.full(len(counts), np.iinfo(np.int64).min)
    np.minimum.at(least, code, before)
    np.maximum.at(most, code, before)
    parts = [w.names.take(pa.array(w.ids[first + k])) for k in range(size)]
    return batch_of(w.lang, pc.binary_join_element_wise(*parts, b" "), counts, least, most)


def marked(bits: int):
    """Places in a bitmap of ``bits`` bits of the phrases (lang, phrase) of Arrow batches."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            at = [phrase_hash(k, p) & (bits - 1) for k, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], ["at"])
    return run
