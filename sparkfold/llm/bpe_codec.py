"""BPE encoding and decoding with content-defined chunk reuse.

1. Every text is cut where a rolling hash of the last 32 bytes has its low bits
   zero, so equal passages give equal chunks wherever they stand.  Chunks are
   identified by a 128-bit digest of their bytes.
2. Chunks that occur more than once are encoded once: one occurrence (the
   owner) supplies the text.  What is stored is the chunk's *body*, the ids
   between its first and its last safe border, and the bytes before and after.
3. A document takes the stored bodies of its repeated chunks and encodes what
   lies between them: unique chunks, and the *joins* (the end of one chunk with
   the start of the next).  A join reaches to the nearest safe border on each
   side; it is accepted when encoding it again with the first word of the next
   body gives the same ids, followed by those of that word.  If they differ the
   join takes in that body and all the rest of the text, which is then encoded
   as one region.

A border is safe before a blank that follows a visible character and is
followed by one: the pre-tokeniser always starts a new piece there and never
looks behind it.

Exactness: ids equal those of the ``tokenizers`` library on the same file.
The byte pairs themselves are merged by ``tiktoken`` on the file's own ranks
for pieces whose characters lie in a range on which both libraries' patterns
agree (checked by test); any other piece goes to ``tokenizers``.

Scale: chunk rows are narrow; texts of owners and of documents that hold
repeated chunks are the only ones that are shuffled (not even these when their
id lists are proven small); the rest is encoded where it was read.

Cases.  Null text: empty.  Rows repeated with one id: a stored chunk is used
only if its digest equals that of the bytes at hand.  Null id: encoded in
place, without reuse.  Empty tables give empty results.  Further columns are
ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import bounded_broadcast, settled
from sparkfold.llm.textbytes import column_bytes, slices

MASK_BITS = 10                # a cut every 1 KiB on average
LEAST, MOST = 256, 8192       # bytes in a chunk
WINDOW = 32
_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
CHUNK = "doc long, ord int, start int, stop int, digest binary"
BODY = "digest binary, head int, tail int, ids binary"
ENCODED = "doc_id long, n_tokens long, ids binary, decoded_sha256 string, ids_sha256 string"


# --- the tokenizer ----------------------------------------------------------------------------------------------

#: characters on which the two libraries' patterns agree: printable ASCII, tab, newline and the letters of Latin-1
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ]*")


class Codec:
    """A tokenizer file of the byte-level kind; one per worker (``codec``)."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        unicode_byte = _byte_alphabet()
        ranks = {bytes(unicode_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in self.special}
        import public_tokenizers
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens=self.special)
        self.split = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    @functools.cached_property
    def slow(self):
        """The library itself, loaded by the first piece that needs it: 28 MB of a worker's memory."""
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.no_truncation()
        found.no_padding()
        return found

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if not _PLAIN.fullmatch(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        if self.split is None or not self.split.search(text):
            return self.fast.encode_ordinary(text)
        out, at = [], 0
        for m in self.split.finditer(text):
            out += self.fast.encode_ordinary(text[at:m.start()])
            out.append(self.special[m.group()])
            at = m.end()
        return out + self.fast.encode_ordinary(text[at:])

    def decode(self, ids: list[int]) -> bytes:
        return self.fast.decode_bytes(ids)


def _byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the others follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


# --- chunks -----------------------------------------------------------------------------------------------------

def cut_points(buf: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash of the last ``WINDOW`` bytes asks for a cut (gear hash, by doubling)."""
    h = _GEAR[buf]
    step = 1
    while step < WINDOW:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return np.flatnonzero((h >> np.uint32(32 - MASK_BITS)) == 0) + 1


def chunk_borders(cuts: np.ndarray, start: int, stop: int) -> list[int]:
    """Chunk borders of one text, of ``LEAST`` to ``MOST`` bytes (the last chunk may be shorter)."""
    out, at = [start], start
    for c in cuts[np.searchsorted(cuts, start + LEAST):np.searchsorted(cuts, stop)].tolist():
        while c - at > MOST:
            at += MOST
            out.append(at)
        if c - at >= LEAST:
            at = c
            out.append(at)
    while stop - at > MOST:
        at += MOST
        out.append(at)
    if stop > at:
        out.append(stop)
    return out


def text_chunks(buf: np.ndarray, borders: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """(row, chunk borders in ``buf``) for every row that is not empty."""
    for a, b in slices(borders):
        lo, hi = int(borders[a]), int(borders[b])
        cuts = cut_points(buf[lo:hi]) + lo
        for row in range(a, b):
            # a window must lie inside its text, else equal texts could be cut differently
            s, e = int(borders[row]), int(borders[row + 1])
            if e > s:
                yield row, chunk_borders(cuts[np.searchsorted(cuts, s + WINDOW):], s, e)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def safe_borders(buf: np.ndarray) -> np.ndarray:
    """Safe positions inside ``buf``: before a blank between two visible characters."""
    if len(buf) < 3:
        return np.zeros(0, np.int64)
    visible = (buf > 0x20) & (buf < 0x7F)
    left = visible.copy()
    left[1:] |= buf[:-1] == 0xC3                       # Latin-1 letters, two bytes each
    right = visible | (buf == 0xC3)
    return np.flatnonzero((buf[1:-1] == 0x20) & left[:-2] & right[2:]) + 1


def find_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        buf, borders = column_bytes(batch.column(1))
        doc, order, start, stop, digest = [], [], [], [], []
        for row, cuts in text_chunks(buf, borders):
            if not ids[row].is_valid:
                continue
            key, base = ids[row].as_py(), int(borders[row])
            for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
                doc.append(key), order.append(k), start.append(s - base), stop.append(e - base)
                digest.append(_digest(buf[s:e].tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(order, pa.int32()), pa.array(start, pa.int32()), pa.array(stop, pa.int32()),
             pa.array(digest, pa.binary())], ["doc", "ord", "start", "stop", "digest"])


def encode_owned(path: str) -> Callable:
    """Batches of (text, owned: the chunks it supplies) -> the stored bodies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            rows = []
            buf, borders = column_bytes(batch.column(0))
            for row, chunks in enumerate(batch.column(1)):
                for c in chunks.as_py() or []:
                    at = int(borders[row]) + c["start"]
                    part = buf[at:int(borders[row]) + c["stop"]]
                    data = part.tobytes()
                    safe = safe_borders(part)
                    if _digest(data) != c["digest"] or len(safe) < 2:
                        continue                        # another row of the same id, or no body to reuse
                    head, tail = int(safe[0]), int(safe[-1])
                    ids = np.array(own.encode(data[head:tail].decode("utf-8")), "<u4").tobytes()
                    rows.append((c["digest"], head, tail, ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.binary(), pa.int32(), pa.int32(), pa.binary()))],
                ["digest", "head", "tail", "ids"])
    return run


def encode_text(own: Codec, data: bytes, known: list[dict] | None) -> list[int]:
    """The ids of a whole text; ``known``: its repeated chunks (start, stop, digest, head, tail, ids)."""
    out: list[int] = []
    at = 0
    for c in sorted(known or [], key=lambda c: c["start"]):
        s, e = c["start"], c["stop"]
        if s + c["head"] < at or e > len(data) or _digest(data[s:e]) != c["digest"]:
            continue
        join = _join(own, data, at, s + c["head"])
        if join is None:
            break                                       # not settled up to the next body: the rest as one region
        out += join
        out += np.frombuffer(c["ids"], "<u4").tolist()
        at = s + c["tail"]
    return out + own.encode(data[at:].decode("utf-8"))


def _join(own: Codec, data: bytes, start: int, stop: int) -> list[int] | None:
    """The ids of ``data[start:stop]``, a region between two bodies; None if they do not agree with what follows.

    The region is encoded again together with the first word of the next body:
    it must give the same ids, followed by those of that word alone."""
    text = data[start:stop].decode("utf-8")
    ids = own.encode(text)
    word = re.match(rb" [!-~]+(?= )", data[stop:stop + 24])
    if word:
        first = word.group().decode("ascii")
        if own.encode(text + first) != ids + own.encode(first):
            return None
    return ids


def encode_docs(path: str, with_known: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            buf, borders = column_bytes(batch.column(1))
            for a, b in slices(borders):
                n, packed, sha, text_sha = [], [], [], []
                for row in range(a, b):
                    data = buf[borders[row]:borders[row + 1]].tobytes()
                    ids = encode_text(own, data, batch.column(2)[row].as_py() if with_known else None)
                    raw = np.array(ids, "<u4").tobytes()
                    text = own.decode(ids).decode("utf-8", "replace").encode("utf-8")
                    n.append(len(ids)), packed.append(raw)
                    sha.append(hashlib.sha256(raw).hexdigest()), text_sha.append(hashlib.sha256(text).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(packed, pa.binary()),
                     pa.array(text_sha, pa.string()), pa.array(sha, pa.string())],
                    ["doc_id", "n_tokens", "ids", "decoded_sha256", "ids_sha256"])
    return run


def encode_corpus(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit), ids_sha256, decoded_sha256 of every row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chunks = settled(texts.mapInArrow(find_chunks, CHUNK), "bpe-chunks")
    shared = settled(
        chunks.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("doc", "start", "stop")).alias("owner"))
        .where("n > 1").select("digest", "owner"), "bpe-shared")
    owned = settled(shared.groupBy(F.col("owner.doc").alias("doc"))
                    .agg(F.collect_list(F.struct("owner.start", "owner.stop", "digest")).alias("owned")), "bpe-owned")
    bodies = settled(texts.join(bounded_broadcast(owned), "doc").select("text", "owned")
                     .mapInArrow(encode_owned(tokenizer_path), BODY).dropDuplicates(["digest"]), "bpe-bodies")
    known = settled(chunks.join(bodies, "digest")
                    .groupBy("doc").agg(F.collect_list(F.struct("start", "stop", "digest", "head", "tail", "ids")).alias("known")),
                    "bpe-known")
    holders = bounded_broadcast(settled(known.select("doc"), "bpe-holders"))
    alone = texts.join(holders, "doc", "left_anti").select("doc", "text")
    reusing = texts.join(holders, "doc", "left_semi").join(known, "doc").select("doc", "text", "known")
    return (alone.mapInArrow(encode_docs(tokenizer_path, False), ENCODED)
            .unionByName(reusing.mapInArrow(encode_docs(tokenizer_path, True), ENCODED)))


def decode_corpus(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and the text of every row of ``encoded`` (doc_id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer_path)
        for batch in batches:
            texts = [own.decode(np.frombuffer(x.as_py() or b"", "<u4").tolist()).decode("utf-8", "replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
