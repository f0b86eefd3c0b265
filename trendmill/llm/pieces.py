"""SentencePiece encoding and decoding of a BPE vocabulary with byte fallback, as a batched lattice search.

The lattice of a word has a node per character and an edge per piece. In the encoding that merging
gives, the last piece of every prefix is the one piece that ends there and does not merge across its
border with the last piece before it; and any chain of pieces that pass this test pair by pair is
the encoding. So a Viterbi pass over the edges that pass, taking the longest at each node and
storing backpointers, yields exactly what merging yields, for all words of one length at a time.

A long word, such as a text without spaces, has no equals to advance with. It is cut into stretches
that overlap and are searched side by side, each as if the word began there. What a node stores
depends only on the characters and on the nodes before it, as many as the longest piece has
characters. So once a stretch has stored the same as the one before it at that many nodes in a row, it
stores what a search of the whole word would, and takes over. Where stretches do not come to agree,
the search goes on from the one before.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill.llm.words import flat, larger_slices, texts_only

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_SIGN = "▁"  # stands for a space in pieces, and is read as one in texts
MEMO_WORDS = 300_000  # encoded words that a worker remembers
MEMO_PAIRS = 1 << 21  # tested pairs that it remembers
SLICE_BYTES = 4 << 20
GATHERED = 1 << 17  # lists
LONG = 64  # characters, beyond which a word is cut
STRETCH = 256  # characters, and
OVERLAP = 64  # those that it shares with the next one
SIDE_BY_SIDE = 512  # stretches

ENCODED = "doc_id BIGINT, token_ids ARRAY<INT>, n_tokens BIGINT, restored BOOLEAN"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
NONE, UNKNOWN = -1, -2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


def _of_chars(points: np.ndarray) -> np.ndarray:
    return _mixed(points.astype(np.uint64) + _ODD)


def _powers(n: int, base: np.uint64) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(n, base)))


def _merged(symbols: list[str], scores: dict[str, float]) -> Iterator[tuple[list[str], float]]:
    """The symbols after every merge of the best pair (the leftmost of equals), with that pair's score."""
    while True:
        pairs = [scores.get(a + b, -np.inf) for a, b in zip(symbols[:-1], symbols[1:], strict=True)]
        best = max(pairs, default=-np.inf)
        if best == -np.inf:
            return
        at = pairs.index(best)
        symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        yield symbols, best


def load(model: str = MODEL) -> dict:
    """The vocabulary of a model file as arrays of bounded size, to be broadcast.

    For each piece: how merging builds it, as hash and length of the first and the last symbol after
    each merge and the score of the next one; pieces that merging does not build are never used.
    """
    import sentencepiece

    reader = sentencepiece.SentencePieceProcessor(model_file=model)
    n = reader.get_piece_size()
    special = [reader.is_control(i) or reader.is_unknown(i) or reader.is_byte(i) for i in range(n)]
    names = [reader.id_to_piece(i) for i in range(n)]
    scores = {names[i]: reader.get_score(i) for i in range(n) if not special[i]}
    if any(SPACE_SIGN in name.lstrip(SPACE_SIGN) for name in scores):
        raise ValueError("pieces that go on after a space are not supported")
    longest = max(map(len, scores))
    power = _powers(longest, _ODD)

    def raw(text: str) -> np.uint64:
        return (_of_chars(np.array([ord(c) for c in text])) * power[: len(text)]).sum(dtype=np.uint64)

    hashes = {name: raw(name) for name in scores}
    for name in list(scores):
        hashes.update((c, raw(c)) for c in name if c not in hashes)
    border = np.zeros((2, n, longest), np.uint64)  # of the first and the last symbol
    length = np.zeros((2, n, longest), np.int8)
    following = np.full((n, longest), -np.inf)
    built = np.zeros(n, bool)
    for i, name in enumerate(names):
        if special[i]:
            continue
        states = [(list(name), None), *_merged(list(name), scores)]
        built[i] = len(states[-1][0]) == 1
        for step, (symbols, _) in enumerate(states):
            for side, symbol in enumerate((symbols[0], symbols[-1])):
                border[side, i, step], length[side, i, step] = hashes[symbol], len(symbol)
            following[i, step] = states[step + 1][1] if step + 1 < len(states) else -np.inf
    surfaces = [
        bytes([int(names[i][3:5], 16)]) if reader.is_byte(i)
        else " ⁇ ".encode() if reader.is_unknown(i)
        else b"" if reader.is_control(i)
        else names[i].replace(SPACE_SIGN, " ").encode()
        for i in range(n)
    ]
    normal = np.array([i for i in range(n) if not special[i]])
    keys = _mixed(np.array([hashes[names[i]] for i in normal]))
    order = np.argsort(keys)
    used = {ord(c) for name in scores for c in name if ord(c) < 128} | {ord(" ")}
    return {
        "keys": keys[order], "ids": normal[order].astype(np.int32), "scores": np.array([scores.get(x, -np.inf) for x in names]),
        "lengths": np.array([len(x) for x in names], np.int8), "built": built, "border": border, "length": length,
        "following": following, "longest": longest, "surfaces": surfaces, "alone": sorted(set(range(128)) - used),
        "bytes": [next(i for i in range(n) if reader.is_byte(i) and surfaces[i] == bytes([b])) for b in range(256)],
        "memo": {},
    }


class Coder:
    """Encodes and decodes by the arrays of ``load``. What it remembers lives as long as these arrays do in a worker."""

    def __init__(self, model: dict):
        self.__dict__.update(model)
        if not self.memo:
            hint = np.zeros(1 << 20, bool)
            hint[self.keys & np.uint64(len(hint) - 1)] = True
            self.memo.update(words={}, hint=hint, pairs=np.full(MEMO_PAIRS, -1, np.int64), verdicts=np.zeros(MEMO_PAIRS, bool))
        self.power = _powers(self.longest + 1, _ODD)
        self.is_alone = np.zeros(256, bool)
        self.is_alone[self.alone] = True

    @cached_property
    def surface(self) -> tuple[np.ndarray, np.ndarray]:
        """All surfaces in one array of bytes, and where each begins."""
        return np.frombuffer(b"".join(self.surfaces), np.uint8), np.append(0, np.cumsum([len(x) for x in self.surfaces]))

    def pieces(self, raw: np.ndarray) -> np.ndarray:
        """The piece of each hash, or NONE: a look into a table of bits, and the sorted keys for what is left."""
        key = _mixed(raw)
        found = np.full(len(key), NONE, np.int32)
        maybe = np.flatnonzero(self.memo["hint"][key & np.uint64(len(self.memo["hint"]) - 1)])
        place = np.minimum(np.searchsorted(self.keys, key[maybe]), len(self.keys) - 1)
        same = self.keys[place] == key[maybe]
        found[maybe[same]] = self.ids[place[same]]
        return found

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves each two pieces, side by side, as they are."""
        pair = left.astype(np.int64) * len(self.built) + right
        slot = (_mixed(pair.astype(np.uint64)) & np.uint64(MEMO_PAIRS - 1)).astype(np.int64)
        pairs, verdicts = self.memo["pairs"], self.memo["verdicts"]
        out = verdicts[slot]
        fresh = np.flatnonzero(pairs[slot] != pair)
        if len(fresh):
            distinct, back = np.unique(pair[fresh], return_inverse=True)
            out[fresh] = self._apart(distinct // len(self.built), distinct % len(self.built))[back]
            pairs[slot[fresh]], verdicts[slot[fresh]] = pair[fresh], out[fresh]
            # Two pairs of one slot may have been written in either order, of key and verdict alike.
        return out

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Replays how both pieces are built, and looks for a merge across the border that would come first."""
        verdict = np.ones(len(left), bool)
        open_ = np.arange(len(left))
        i, j = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        while len(open_):
            a, b, x, y = left[open_], right[open_], i[open_], j[open_]
            n = self.length[1, a, x].astype(np.int64)
            total = n + self.length[0, b, y]
            cross = self.pieces(self.border[1, a, x] + self.border[0, b, y] * self.power[np.minimum(n, self.longest)])
            score = np.where((cross != NONE) & (total <= self.longest), self.scores[cross], -np.inf)
            own, other = self.following[a, x], self.following[b, y]
            merges = (score > own) & (score >= other) & (score > -np.inf)
            verdict[open_[merges]] = False
            i[open_], j[open_] = x + (own >= other), y + (own < other)
            open_ = open_[~merges & ((own > -np.inf) | (other > -np.inf))]
        return verdict

    def _last(self, points: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        """The last piece of every prefix of words of one length, a row of characters each.

        known: what the first nodes store, if the rows go on from an earlier search.
        """
        m, n = points.shape
        powers, back_powers = _powers(n, _ODD), _powers(n, _INVERSE)
        total = np.zeros((m, n + 1), np.uint64)
        np.cumsum(_of_chars(points) * powers[:n], axis=1, out=total[:, 1:])
        edges = {}
        for span in range(1, min(n, self.longest) + 1):
            raw = (total[:, span:] - total[:, : n - span + 1]) * back_powers[: n - span + 1]
            found = self.pieces(raw.ravel())
            fit = (found != NONE) & self.built[found] & (self.lengths[found] == span)
            edges[span] = np.where(fit, found, NONE).reshape(raw.shape)
        last, first = np.full((m, n + 1), NONE, np.int32), 1
        if known is not None:
            first = known.shape[1]
            last[:, :first] = known
        for node in range(first, n + 1):
            open_ = np.arange(m)
            for span in range(min(node, self.longest), 0, -1):
                piece, before = edges[span][open_, node - span], last[open_, node - span]
                fits = piece != NONE
                test = np.flatnonzero(fits & (before >= 0))
                fits[test] = self.apart(before[test], piece[test])
                if span == 1:  # a character without a piece stands alone
                    piece, fits = np.where(piece == NONE, UNKNOWN, piece), fits | (piece == NONE)
                done = open_[fits]
                last[done, node] = piece[fits]
                open_ = open_[~fits]
                if not len(open_):
                    break
            if len(open_):
                raise ValueError("no piece ends a prefix, which cannot be in a vocabulary that merging built")
        return last

    def _spans(self, last: np.ndarray) -> np.ndarray:
        """How far back each node points."""
        return np.where(last >= 0, self.lengths[last], 1)

    def _search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words of one length (a row of characters each): how many, and all of them in a row."""
        m, n = points.shape
        last = self._last(points)
        span_of = self._spans(last)
        at, row, out = np.full(m, n), np.arange(m), np.full((m, n), NONE, np.int32)
        for step in range(n - 1, -1, -1):  # backpointers, for all words at once
            going = at > 0
            if not going.any():
                break
            out[going, step] = last[row[going], at[going]]
            at[going] -= span_of[row[going], at[going]]
        return (out != NONE).sum(axis=1), out[out != NONE]

    def _stretches(self, parts: list[tuple[np.ndarray, int]]) -> np.ndarray:
        """What the nodes of a stretch from each place of a word store; the last of a word is filled up."""
        rows = np.zeros((len(parts), STRETCH + OVERLAP), np.uint32)
        for row, (word, at) in zip(rows, parts, strict=True):
            part = word[at : at + len(row)]
            row[: len(part)] = part
        return self._last(rows)

    def _search_long(self, words: list[np.ndarray]) -> Iterator[np.ndarray]:
        """The pieces of each word of any length. Stretches of all words advance together."""
        cuts = [(k, at) for k, word in enumerate(words) for at in range(0, max(1, len(word) - OVERLAP), STRETCH)]
        stored = [np.full(len(word) + 1, NONE, np.int32) for word in words]
        known = [0] * len(words)  # the last node of each word that is searched
        for first in range(0, len(cuts), SIDE_BY_SIDE):
            some = cuts[first : first + SIDE_BY_SIDE]
            for (k, at), last in zip(some, self._stretches([(words[k], at) for k, at in some]), strict=True):
                known[k] = self._joined(stored[k], known[k], at, last)
        for word, last, reached in zip(words, stored, known, strict=True):
            self._go_on(word, last, reached)
            spans, at, found = self._spans(last).tolist(), len(last) - 1, []
            while at:
                found.append(at)
                at -= spans[at]
            yield last[found[::-1]]

    def _joined(self, stored: np.ndarray, known: int, at: int, last: np.ndarray) -> int:
        """Take over what a stretch from ``at`` has stored, if it agrees with what is known; the last node known then."""
        end, need = min(len(stored) - 1, at + len(last) - 1), self.longest
        if at:
            same = np.append(0, np.cumsum(stored[at + 1 : known + 1] == last[1 : max(1, known - at + 1)]))
            if not (same[need:] - same[:-need] == need).any():
                return known
        stored[known + 1 : end + 1] = last[known - at + 1 : end - at + 1]
        return end

    def _go_on(self, word: np.ndarray, stored: np.ndarray, known: int) -> None:
        """Search the rest of a word, of which a stretch did not agree: from where a piece ends, as in runs of one character.

        If that does not agree either, one stretch is searched from what is known. The more stretches
        have agreed, the more are tried at once, so that little is searched in vain.
        """
        tried = 8
        while known < len(word):
            at, spans = known, self._spans(stored[known - 2 * OVERLAP : known + 1]).tolist()
            while known - at < OVERLAP:
                at -= spans[at - known - 1]
            starts = range(at, max(at + 1, len(word) - OVERLAP), STRETCH)[:tried]
            before = known
            for start, last in zip(starts, self._stretches([(word, start) for start in starts]), strict=True):
                reached = self._joined(stored, known, start, last)
                if reached == known:
                    tried = 2
                    break
                known = reached
            tried = min(4 * tried, SIDE_BY_SIDE)
            if known == before:
                begin, end = known - self.longest, min(len(word), known + STRETCH)
                stored[begin : end + 1] = self._last(word[None, begin:end], stored[None, begin : known + 1])[0]
                known = end

    def words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes of 32-bit numbers. Long words are not remembered."""
        memo, long = self.memo["words"], {}
        fresh = [word for word in words if word not in memo]
        if fresh:
            if len(memo) + len(fresh) > MEMO_WORDS:
                memo.clear()
                fresh = words
            points = np.frombuffer(b"".join(fresh).decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            points = np.where(points == 32, ord(SPACE_SIGN), points)
            data = np.frombuffer(b"".join(fresh), np.uint8)
            edges = np.append(0, np.cumsum(np.fromiter(map(len, fresh), np.int64, len(fresh))))
            begun = np.append(0, np.cumsum((data & 0xC0) != 0x80))[edges]  # characters before each word
            starts, sizes = begun[:-1], np.diff(begun)
            lengthy = np.flatnonzero(sizes > LONG).tolist()
            parts = [points[starts[k] : starts[k] + sizes[k]] for k in lengthy]
            for k, part, ids in zip(lengthy, parts, self._search_long(parts), strict=True):
                long[fresh[k]] = (self._with_bytes(part, ids) if (ids == UNKNOWN).any() else ids).tobytes()
            for size in np.unique(sizes[sizes <= LONG]):
                own = np.flatnonzero(sizes == size)
                rows = points[starts[own][:, None] + np.arange(size)]
                count, ids = self._search(rows)
                beyond = np.cumsum(count)
                strange = np.flatnonzero(np.add.reduceat(ids == UNKNOWN, beyond - count))
                whole, ends = ids.tobytes(), (4 * beyond).tolist()
                memo.update(zip([fresh[k] for k in own.tolist()], map(whole.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
                for k in strange.tolist():
                    memo[fresh[own[k]]] = self._with_bytes(rows[k], ids[beyond[k] - count[k] : beyond[k]]).tobytes()
        return [long[word] if word in long else memo[word] for word in words]

    def _with_bytes(self, points: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The ids with the bytes of each character that has no piece."""
        out, at = [], 0
        for piece in ids.tolist():
            out += [self.bytes[b] for b in chr(points[at]).encode()] if piece == UNKNOWN else [piece]
            at += 1 if piece == UNKNOWN else int(self.lengths[piece])
        return np.array(out, np.int32)

    def encode(self, texts: pa.Array) -> pa.Array:
        """A list of ids for each text; null and empty texts have none.

        A word is a run of spaces with what follows it; characters of ASCII that are in no piece are
        words of their own, as nothing merges with them.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pc.replace_substring(texts, SPACE_SIGN, " ")
        nothing, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        spaced = pc.binary_join_element_wise(nothing, texts, space)
        data, bounds = flat(pc.if_else(pc.equal(texts, ""), texts, spaced))
        if not len(data):
            return pa.ListArray.from_arrays(np.zeros(len(texts) + 1, np.int32), pa.array([], pa.int32()))
        alone = self.is_alone[data]
        space = data == 32
        cut = alone.copy()
        cut[1:] |= alone[:-1] | (space[1:] & ~space[:-1])
        cut[bounds[:-1][bounds[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        buffers = [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        codes = coded.indices.to_numpy()
        found = self.words(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = _gathered(np.frombuffer(b"".join(found), np.int32), np.cumsum(sizes) - sizes, sizes, codes)
        ends = np.append(0, np.cumsum(sizes[codes]))[np.searchsorted(starts, bounds)]
        return pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(ids))

    def decode(self, lists: pa.Array) -> pa.Array:
        """The text of each list of ids; null counts as an empty list, and bytes that are no text become U+FFFD."""
        ids = lists.flatten().to_numpy()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        data, places = self.surface
        width = np.diff(places)
        out = _gathered(data, places[:-1], width, ids)
        bounds = np.append(0, np.cumsum(width[ids]))[np.append(0, np.cumsum(sizes))]
        first = np.minimum(bounds[:-1], max(0, len(out) - 1))
        skip = (out[first] == 32) & (bounds[1:] > bounds[:-1]) if len(out) else np.zeros(len(sizes), bool)
        whole = out.tobytes()
        spans = zip((bounds[:-1] + skip).tolist(), bounds[1:].tolist(), strict=True)
        return pa.array([whole[s:e].decode("utf-8", "replace") for s, e in spans], pa.string())


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The stretches of data that the codes stand for, one after the other; some at a time, as places take more room than data."""
    parts = [np.empty(0, data.dtype)]
    for at in range(0, len(codes), GATHERED):
        some = codes[at : at + GATHERED]
        count = sizes[some]
        shift = np.repeat(starts[some] - (np.cumsum(count) - count), count)
        shift += np.arange(len(shift))
        parts.append(data[shift])
    return np.concatenate(parts)


def encoded(
    docs: DataFrame, model: str = MODEL, id_column: str = "doc_id", text_column: str = "text", slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """doc_id, token_ids, n_tokens and restored of each whole text.

    restored: whether decoding the ids gives the text back, with U+2581 read as a space. model: a
    SentencePiece BPE model file with byte fallback and identity normalisation, on the driver.
    Null texts count as empty, which have no ids. Smaller slices take less memory and more time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in larger_slices(batches, "text", slice_bytes):
            ids = coder.encode(batch["text"])
            plain = pc.replace_substring(pc.fill_null(batch["text"], ""), SPACE_SIGN, " ")
            same = pc.equal(coder.decode(ids), plain.cast(pa.string()))
            count = pc.list_value_length(ids).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], ids, count, same], ["doc_id", "token_ids", "n_tokens", "restored"])

    rows = texts_only(docs, id_column, text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(work, ENCODED)


def decoded(rows: DataFrame, model: str = MODEL, id_column: str = "doc_id", ids_column: str = "token_ids") -> DataFrame:
    """doc_id and text of each list of token ids."""
    shared = rows.sparkSession.sparkContext.broadcast(load(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], coder.decode(batch["token_ids"])], ["doc_id", "text"])

    own = rows.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{ids_column}`").alias("token_ids"))
    return own.mapInArrow(work, "doc_id BIGINT, text STRING")
