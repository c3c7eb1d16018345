"""Packing whole documents into sequences of bounded length: best fit, then a swap-based local search."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelight.llm.common import pieces_of, release, stored, table

CAPACITY = 2048
END = (0).to_bytes(4, "little")
ROWS_PER_GROUP = 20_000
PASSES, STEPS, DONORS, WIDEST = 2, 64, 400, 6
CACHE_BYTES = 128 << 20  # of words and their ids in a worker
TOKENIZER = "word_bpe_49k.json"
PROBE = "The  cat's Na\u00efve stra\u00dfe,\nco-op. \u00c9t\u00e9 12ab (x) qwxz don't e\u0301 \u0130 a.b ,. tz".encode()
MARKS = "!#$%&*+,-./:;?@^_|~()[]{}=>"
_CACHES: dict[str, tuple[object, Recent]] = {}


class Recent:
    """A map of words to ids of about ``CACHE_BYTES``: two halves, of which the older goes when the newer is full. A word met
    again moves to the newer one, so frequent words stay."""

    ENTRY = 150  # bytes of two small byte strings and a slot, besides their contents

    def __init__(self, limit: int = CACHE_BYTES) -> None:
        self.new, self.old, self.half, self.used = {}, {}, limit // 2, 0

    def get(self, word: bytes) -> bytes | None:
        found = self.new.get(word)
        if found is None:
            found = self.old.get(word)
            if found is not None:
                self.put(word, found)
        return found

    def put(self, word: bytes, ids: bytes) -> bytes:
        size = self.ENTRY + len(word) + len(ids)
        if size <= self.half:
            if self.used + size > self.half:
                self.old, self.new, self.used = self.new, {}, 0
            self.new[word] = ids
            self.used += size
        return ids


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: itself where printable, else the next free one from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def encoder(path: str) -> Callable[[bytes], bytes]:
    """A function from a text to its ids as little-endian 32-bit numbers, equal to encoding the whole text.

    The rules of the default vocabulary never join anything across white space, so ids are kept per word between ASCII blanks,
    and a lower-case word of Latin letters goes to the tokenizer's model without the rules before it. A vocabulary for which
    a probe shows this to be wrong encodes whole texts.
    """
    from tokenizers import Tokenizer

    if path not in _CACHES:
        _CACHES[path] = (Tokenizer.from_file(path), Recent())
    tokenizer, known = _CACHES[path]
    letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})

    def whole(text: bytes) -> bytes:
        return np.array(tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def of_word(word: bytes) -> bytes:
        name = word.decode("utf-8", "replace")
        if name.isalpha() and max(name) < "\u0250" and name.lower() == name:
            return np.array([t.id for t in tokenizer.model.tokenize(word.decode("latin-1").translate(letters))], "<u4").tobytes()
        base = name.rstrip(MARKS)
        if base != name and base.isalpha():  # letters, then marks: two tokens of the rules, whatever they are
            cut = len(base.encode())
            return b"".join(known.get(part) or known.put(part, of_word(part)) for part in (word[:cut], word[cut:]))
        return whole(word)

    def encode(text: bytes) -> bytes:
        words = (text if b"<|" in text else text.lower()).split()
        ids = list(map(known.new.get, words))
        if None in ids:
            for i, found in enumerate(ids):
                if found is None:
                    ids[i] = known.get(words[i]) or known.put(words[i], of_word(words[i]))
        return b"".join(ids)

    return encode if encode(PROBE) == whole(PROBE) else whole


def _pieces(path: str, capacity: int, schema: T.StructType, with_ids: bool):
    def run(batches):
        release()
        encode = encoder(path)
        for batch in batches:
            for part in pieces_of(batch, 2 << 20):
                doc, piece, start, length, crc, ids = [], [], [], [], [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    raw = encode((text or "").encode("utf-8", "replace")) + END
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        own = raw[at : at + 4 * capacity]
                        doc.append(row)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        if with_ids:
                            ids.append(np.frombuffer(own, "<u4").tolist())
                columns = [part.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), schema.names)

    return run


def tokenized(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and an end id 0, cut only where longer than
    ``capacity``. A null text is as empty: one piece of the end id alone."""
    docs = docs.select("doc_id", "text")
    names = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    names += [("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(*x) for x in names]])
    return docs.mapInArrow(_pieces(path or default_tokenizer(), capacity, schema, with_ids), schema)


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: largest first, each into the fullest bin that still takes it."""
    bins = np.zeros(len(sizes), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, count = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = mask >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            own = by_space[space].pop()
            if not by_space[space]:
                mask ^= 1 << space
        else:
            space, own = capacity, count
            count += 1
        bins[i] = own
        left = space - size
        if left:
            by_space[left].append(own)
            mask |= 1 << left
    return bins


def local_search(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Empties bins of a packing by moves and exchanges between underfull bins.

    The emptiest bins give, one after the other: they move an item, or swap one or two of their items for one smaller item
    of another underfull bin, whichever fills that bin most. Every step must raise the sum of squared fills, so none is
    undone. A bin gives at most STEPS times, and the DONORS emptiest bins are tried in each of PASSES passes.
    """
    bins, n = bins.copy(), int(bins.max(initial=-1)) + 1
    fill = np.bincount(bins, sizes, n).astype(np.int64)
    members = [[] for _ in range(n)]
    for i, b in enumerate(bins.tolist()):
        members[b].append(i)
    for _ in range(PASSES):
        emptied = 0
        for donor in np.argsort(fill, kind="stable")[:DONORS].tolist():
            if not 0 < fill[donor] < capacity:
                continue
            items = np.flatnonzero((fill[bins] < capacity) & (bins != donor))
            for _ in range(STEPS):
                best, mine = (0, None, ()), sorted(members[donor], key=lambda i: -sizes[i])[:WIDEST]
                gap = capacity - fill
                gap[donor] = 0
                gap[fill == 0] = 0
                own = bins[items]
                room, needed = gap[own], fill[donor] - fill[own]
                for size, out in [(int(sizes[i]), (i,)) for i in mine] + [(int(sizes[i] + sizes[j]), (i, j)) for k, i in enumerate(mine) for j in mine[k + 1 :]]:
                    if len(out) == 1:  # a move
                        takes = np.flatnonzero((gap >= size) & (fill + size > fill[donor]))
                        if len(takes) and size > best[0]:
                            best = (size, (None, int(takes[gap[takes].argmin()])), out)
                    gain = size - sizes[items]
                    good = np.flatnonzero((gain > best[0]) & (gain <= room) & (gain > needed))
                    if len(good):
                        at = good[gain[good].argmax()]
                        best = (int(gain[at]), (int(items[at]), int(own[at])), out)
                gain, swap, out = best
                if not out:
                    break
                back, to = swap
                for i in out:
                    members[donor].remove(i)
                    members[to].append(i)
                    bins[i] = to
                if back is not None:
                    members[to].remove(back)
                    members[donor].append(back)
                    bins[back] = donor
                fill[to] += gain
                fill[donor] -= gain
                if not fill[donor]:
                    emptied += 1
                    break
        if not emptied:
            break
    return bins


def pack(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each item, numbered from 0 without gaps."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    return np.unique(local_search(sizes, best_fit(sizes, capacity), capacity), return_inverse=True)[1]


def _pack_group(capacity: int, names: list[str]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        bins = pack(group.length.to_numpy(), capacity)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(group.length.to_numpy()[order])
        begin = ends - group.length.to_numpy()[order]
        first = np.append(True, bins[order][1:] != bins[order][:-1])
        offset = np.empty(len(group), np.int64)
        offset[order] = begin - np.repeat(begin[first], np.diff(np.append(np.flatnonzero(first), len(group))))
        return group.assign(sequence_id=(group.group.to_numpy() << 32) + bins, offset=offset)[names]

    return run


def packed(pieces: DataFrame, capacity: int = CAPACITY, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Pieces of at most ``capacity`` ids with their sequence and place in it: adds sequence_id and offset.

    Pieces are dealt by a hash into groups of about ``rows_per_group``, each packed by itself, so a group wastes at most
    part of a sequence over packing all at once. Equal pieces are spread by their number, not by their content alone.
    """
    pieces = stored(pieces, "pieces")
    groups = max(1, -(-pieces.count() // rows_per_group))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32"), F.lit(groups)))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return dealt.groupBy("group").applyInPandas(_pack_group(capacity, schema.names), schema)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    A document no longer than ``capacity`` ids stays whole. Null ids are kept, rows that repeat an id are documents of their
    own, an empty table gives no sequence. Columns other than doc_id and text are not read.
    """
    return packed(tokenized(docs, path, capacity), capacity)


def sequences(docs: DataFrame, places: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from documents with distinct ids and their places."""
    parts = tokenized(docs, path, capacity, with_ids=True).select("doc_id", "piece", "ids")
    joined = parts.join(places.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # a sequence holds at most ``capacity`` ids
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))


def op2_swap_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return pack_documents(table(spark, folder, "documents"))
