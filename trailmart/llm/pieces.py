"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

A text is cut into words that no piece can reach across, each distinct word of a batch is
encoded once, and all of them are merged together: one flat array of symbols, the lowest
pair rank of every word, all leftmost non-overlapping merges of that rank at once, then
compaction; words without a mergeable pair leave the arrays. Ranks that equal ones share,
or whose product could be preferred to the pair itself, merge one place per round, so the
result is that of the one-merge-at-a-time procedure.
"""

from __future__ import annotations

import pickle
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmart.llm.common import Codes

SPACE = "▁"
UNKNOWN_SURFACE = " ⁇ "
NO_RANK = np.iinfo(np.int32).max
#: Symbols for characters without a piece start here, above any vocabulary.
LOOSE = 1 << 24
#: Characters merged together, and distinct words remembered, at a time.
CHUNK_CHARS = 1 << 20
CACHE_WORDS = 600_000


class Pieces:
    """Merge tables of one BPE model; its size is that of the vocabulary."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as file:
            model.ParseFromString(file.read())
        norm = model.normalizer_spec
        if (
            model.trainer_spec.model_type != 2
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.escape_whitespaces
            or model.trainer_spec.treat_whitespace_as_suffix
        ):
            raise ValueError("only BPE models with identity normalisation are supported")
        processor = SentencePieceProcessor(model_file=model_path)
        size = processor.get_piece_size()
        self.prefix = norm.add_dummy_prefix
        self.unknown, self.end = processor.unk_id(), processor.eos_id()
        names = [processor.id_to_piece(i) for i in range(size)]
        raw = [b""] * size
        self.starts_word = np.zeros(size, bool)
        self.silent = np.zeros(size, bool)
        self.byte_ids = [self.unknown] * 256
        self.bytes_known = False
        ids = {}
        for i, name in enumerate(names):
            if processor.is_control(i):
                self.silent[i] = True
            elif processor.is_unknown(i):
                raw[i] = UNKNOWN_SURFACE.encode()
            elif processor.is_byte(i):
                value = int(name[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_known = True
                raw[i] = bytes([value])
            else:
                if processor.is_unused(i) or model.pieces[i].type == 4:
                    raise ValueError("unused and user-defined pieces are not supported")
                ids[name] = i
                raw[i] = name.replace(SPACE, " ").encode()
                self.starts_word[i] = name.startswith(SPACE)
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_sizes = np.array([len(part) for part in raw])
        self.raw_begins = np.cumsum(self.raw_sizes) - self.raw_sizes
        self._merges(ids, processor)
        self._words(ids)

    def _merges(self, ids, processor) -> None:
        self.symbols = np.arange(0x110000, dtype=np.int32) + LOOSE
        for name, i in ids.items():
            if len(name) == 1:
                self.symbols[ord(name)] = i
        # Texts are cut as they are: a space stands for the sign that replaces it.
        self.symbols[ord(" ")] = self.symbols[ord(SPACE)]
        levels = sorted({-processor.get_score(i) for i in ids.values()})
        rank_of_score = {score: rank for rank, score in enumerate(levels)}
        rank = {i: rank_of_score[-processor.get_score(i)] for i in ids.values()}

        def symbol(part: str):
            return ids.get(part, LOOSE + ord(part) if len(part) == 1 else None)

        pairs, shared = {}, {}
        alone = set()
        for name, i in ids.items():
            if len(name) > 1:
                shared.setdefault(rank[i], set()).add(i)
            for cut in range(1, len(name)):
                left, right = symbol(name[:cut]), symbol(name[cut:])
                if left is None or right is None:
                    continue
                pairs[left << 32 | right] = (rank[i], i)
                # A product preferred to one of its own parts must not be overtaken.
                alone.update(rank[part] for part in (left, right) if part in rank and rank[i] <= rank[part])
        alone.update(level for level, members in shared.items() if len(members) > 1)
        keys = list(pairs)
        self.pairs = PairTable(np.array(keys, np.int64))
        self.ranks = np.array([*(pairs[key][0] for key in keys), NO_RANK], np.int32)
        self.merged = np.array([*(pairs[key][1] for key in keys), -1], np.int32)
        self.one_at_a_time = np.zeros(len(levels) + 1, bool)
        self.one_at_a_time[sorted(alone)] = True

    def _words(self, ids) -> None:
        """How to cut a text, and character pairs that some piece has side by side."""
        inside = {char for name in ids if len(name) > 1 for char in name}
        reaches_over = any(SPACE in name.lstrip(SPACE) for name in ids)
        if reaches_over or "\n" in inside:
            self.cut = re.compile(r"[\s\S]+")
        else:
            self.cut = re.compile(" *[^ \n]+| +|\n")
        shown = [name.replace(SPACE, " ") for name in ids]
        beside = {ord(a) << 32 | ord(b) for name in shown for a, b in zip(name, name[1:], strict=False)}
        self.beside = PairTable(np.array(list(beside), np.int64))

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        return self.cut.findall((" " if self.prefix else "") + text.replace(SPACE, " "))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        opens = np.zeros(len(codes), bool)
        opens[0] = True
        opens[ends[:-1]] = True
        opens[1:] |= self.beside.find(codes[:-1] << 32 | codes[1:]) < 0
        places, ids = self._rounds(self.symbols[codes].astype(np.int64), np.cumsum(opens) - 1)
        places, ids = self._bytes(places, ids)
        return ids, np.diff(np.searchsorted(places, np.append(0, ends)))

    def _rounds(self, symbols, segment):
        """Merge until no pair is left; returns the places and ids of what remains."""
        place = np.arange(len(symbols))
        done_places, done_symbols = [], []
        pair = self._pairs(symbols, segment, place)
        while len(symbols):
            rank = self.ranks[pair]
            first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(symbols)))
            open_ = best != NO_RANK
            if not open_.all():
                live = np.repeat(open_, sizes)
                done_places.append(place[~live])
                done_symbols.append(symbols[~live])
                symbols, segment, place, rank, pair = (x[live] for x in (symbols, segment, place, rank, pair))
                sizes, best = sizes[open_], best[open_]
                if not len(symbols):
                    break
            index = np.flatnonzero(rank == np.repeat(best, sizes))
            # Of a row of overlapping places every other one merges, from the left.
            number = np.arange(len(index))
            fresh = np.concatenate([[True], np.diff(index) > 1])
            keep = (number - np.maximum.accumulate(np.where(fresh, number, 0))) % 2 == 0
            careful = self.one_at_a_time[rank[index]]
            if careful.any():
                owner = segment[index]
                keep &= ~careful | np.concatenate([[True], owner[1:] != owner[:-1]])
            index = index[keep]
            symbols[index] = self.merged[pair[index]]
            stay = np.ones(len(symbols), bool)
            stay[index + 1] = False
            symbols, segment, place, pair = symbols[stay], segment[stay], place[stay], pair[stay]
            # Only pairs with a merged symbol are looked up again.
            moved = index - np.arange(len(index))
            touched = np.concatenate([moved, moved[moved > 0] - 1])
            pair[touched] = self._pairs(symbols, segment, touched)
        places = np.concatenate([*done_places, np.zeros(0, np.int64)])
        order = np.argsort(places, kind="stable")
        return places[order], np.concatenate([*done_symbols, np.zeros(0, np.int64)])[order]

    def _pairs(self, symbols, segment, at):
        """Number of the pair that begins at each place, -1 where there is none."""
        following = np.minimum(at + 1, len(symbols) - 1)
        found = self.pairs.find(symbols[at] << 32 | symbols[following])
        found[(segment[at] != segment[following]) | (following == at)] = -1
        return found

    def _bytes(self, places, ids):
        """Characters without a piece become their UTF-8 bytes, or the unknown id."""
        loose = np.flatnonzero(ids >= LOOSE)
        if not len(loose):
            return places, ids
        parts = [
            [self.byte_ids[v] for v in chr(c - LOOSE).encode()] if self.bytes_known else [self.unknown]
            for c in ids[loose].tolist()
        ]
        times = np.ones(len(ids), np.int64)
        times[loose] = [len(part) for part in parts]
        places, ids = np.repeat(places, times), np.repeat(ids, times)
        ids[ids >= LOOSE] = list(chain.from_iterable(parts))
        return places, ids

    def decode_lists(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of the texts of all lists one after the other, and where each begins.

        A byte that is not part of valid UTF-8 becomes U+FFFD. One space that begins the
        text as part of its first piece was put there by encoding and goes.
        """
        begins, sizes = self.raw_begins[ids], self.raw_sizes[ids]
        if self.prefix:
            # The first piece of each list that shows anything, if there is one.
            loud = np.flatnonzero(~self.silent[ids])
            first = np.searchsorted(loud, offsets[:-1])
            first = loud[first[first < len(loud)]]
            own = np.searchsorted(offsets, first, side="right") - 1
            first = np.unique(first[first < offsets[own + 1]])
            first = first[self.starts_word[ids[first]]]
            begins[first] += 1
            sizes[first] -= 1
        ends = np.cumsum(sizes)
        data = self.raw[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[offsets]
        # Bytes of one character must be neighbours within one list.
        breaks = np.concatenate([cuts, ends[self.silent[ids]]])
        breaks = breaks[breaks < len(data)]
        torn = (data[breaks] & 0xC0 == 0x80).any()
        try:
            if not torn:
                data.tobytes().decode()
        except UnicodeDecodeError:
            torn = True
        if torn:
            stops = np.concatenate([[0], ends])
            texts = []
            for low, high in zip(offsets[:-1], offsets[1:], strict=True):
                parts = np.split(stops[low : high + 1], np.flatnonzero(self.silent[ids[low:high]]) + 1)
                edges = [stops[low], *(part[0] for part in parts[1:] if len(part)), stops[high]]
                texts.append("".join(lenient(data[a:b].tobytes()) for a, b in zip(edges, edges[1:], strict=False)).encode())
            data = np.frombuffer(b"".join(texts), np.uint8)
            cuts = np.concatenate([[0], np.cumsum([len(text) for text in texts])])
        return data, cuts

    def decode(self, ids) -> str:
        """Text of one list of ids."""
        ids = np.asarray(ids, np.int64)
        return self.decode_lists(ids, np.array([0, len(ids)]))[0].tobytes().decode()


class PairTable:
    """Places of 64-bit keys in a fixed list: each key is in one of two cells."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys)).bit_length() + 1)
        for seed in range(100):
            self.factors = [(0x9E3779B97F4A7C15 + 2 * seed) % 2**64, (0xC2B2AE3D27D4EB4F + 4 * seed) % 2**64]
            if self._place(keys):
                return
        raise ValueError("keys cannot be placed")

    def _cells(self, keys: np.ndarray, k: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = (keys.view(np.uint64) ^ (keys.view(np.uint64) >> np.uint64(29))) * np.uint64(self.factors[k])
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64) + (k << self.bits)

    def _place(self, keys: np.ndarray) -> bool:
        choices = np.stack([self._cells(keys, 0), self._cells(keys, 1)], axis=1).tolist()
        owner = {}
        for key in range(len(keys)):
            moving, cell = key, choices[key][0]
            for _ in range(200):
                moving, owner[cell] = owner.get(cell), moving
                if moving is None:
                    break
                a, b = choices[moving]
                cell = b if cell == a else a
            else:
                return False
        self.places = np.full(2 << self.bits, -1, np.int32)
        self.places[list(owner)] = list(owner.values())
        # No key is -1, so empty cells never match.
        self.keys = np.full(2 << self.bits, -1, np.int64)
        self.keys[list(owner)] = keys[list(owner.values())]
        return True

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 for those not in the list."""
        keys = np.ascontiguousarray(keys)
        one, two = self._cells(keys, 0), self._cells(keys, 1)
        found = np.where(self.keys[two] == keys, self.places[two], np.int32(-1))
        return np.where(self.keys[one] == keys, self.places[one], found)


def lenient(raw: bytes) -> str:
    """UTF-8 text in which every single stray byte is U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


class WordIds:
    """Ids of words, worked out for all new words together and remembered."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.codes = pieces, Codes()
        self.flat, self.begins, self.sizes = (np.zeros(0, np.int64) for _ in range(3))

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has."""
        if len(self.codes) > CACHE_WORDS:
            self.__init__(self.pieces)
        index = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        if self.codes.fresh:
            ids, sizes = self.pieces.encode_words(self.codes.fresh)
            self.begins = np.concatenate([self.begins, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, ids])
            self.codes.fresh.clear()
        sizes = self.sizes[index]
        ends = np.cumsum(sizes)
        where = np.repeat(self.begins[index] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[where], sizes


def encode_batch(known: WordIds, texts: list[str | None]) -> list[np.ndarray]:
    """Ids of each text followed by the end id."""
    result, waiting, chars = [], [], 0
    for k, text in enumerate(texts):
        waiting.append(known.pieces.words(text or ""))
        chars += len(text or "")
        if chars < CHUNK_CHARS and k + 1 < len(texts):
            continue
        ids, sizes = known.of(list(chain.from_iterable(waiting)))
        cuts = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([len(words) for words in waiting])]
        result += [np.append(part, known.pieces.end) for part in np.split(ids, cuts)[:-1]]
        waiting, chars = [], 0
    return result


class Tokenizer:
    """Encode and decode columns; the model is read once, on the driver.

    A null text is encoded like an empty one (the end id alone); null ids decode to null.
    """

    def __init__(self, spark: SparkSession, model_path: str):
        # As plain bytes: a broadcast object would need this package on the executors.
        self.pieces = spark.sparkContext.broadcast(cloudpickle.dumps(Pieces(model_path)))

    def encode(self, text: Column) -> Column:
        shared, state = self.pieces, {}

        @F.arrow_udf("array<int>")
        def encoded(texts: pa.Array) -> pa.Array:
            if not state:
                state["words"] = WordIds(pickle.loads(shared.value))
            ids = encode_batch(state["words"], texts.to_pylist())
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            return pa.ListArray.from_arrays(offsets, np.concatenate([*ids, np.zeros(0)]).astype(np.int32))

        return encoded(text)

    def decode(self, ids: Column) -> Column:
        shared, state = self.pieces, {}

        @F.arrow_udf("string")
        def decoded(lists: pa.Array) -> pa.Array:
            if not state:
                state["pieces"] = pickle.loads(shared.value)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            data, cuts = state["pieces"].decode_lists(ids, np.concatenate([[0], np.cumsum(sizes)]))
            buffers = [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
            texts = pa.StringArray.from_buffers(len(lists), *buffers[1:])
            return pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string())) if lists.null_count else texts

        return decoded(ids)

    def round_trip(self, text: Column) -> Column:
        """Ids of a text and the text decoded from them, in one visit to Python."""
        shared, state = self.pieces, {}

        @F.arrow_udf(T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]))
        def there_and_back(texts: pa.Array) -> pa.Array:
            if not state:
                state["words"] = WordIds(pickle.loads(shared.value))
            lists = encode_batch(state["words"], texts.to_pylist())
            ids = np.concatenate([*lists, np.zeros(0)]).astype(np.int32)
            offsets = np.cumsum([0, *map(len, lists)])
            data, cuts = state["words"].pieces.decode_lists(ids, offsets)
            decoded = pa.StringArray.from_buffers(
                len(lists), pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())
            )
            encoded = pa.ListArray.from_arrays(offsets.astype(np.int32), ids)
            return pa.StructArray.from_arrays([encoded, decoded], ["ids", "decoded"])

        return there_and_back(text)


def documents_as_ids(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids of the whole text with the end id, and the text decoded from them."""
    tokenizer = Tokenizer(docs.sparkSession, model_path)
    return docs.select("doc_id", tokenizer.round_trip(F.col("text")).alias("both")).select("doc_id", "both.*")


def digests(encoded: DataFrame) -> DataFrame:
    """Count and hashes of what ``documents_as_ids`` returns."""
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
