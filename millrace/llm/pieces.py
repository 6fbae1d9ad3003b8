"""SentencePiece BPE encoding by suffix-array matching, and decoding."""

from __future__ import annotations

import functools
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_slices

SPACE = "▁"
CACHED_BYTES, LONGEST_CACHED = 16 << 20, 64  # runs remembered; longer ones are merged anew each time
ENTRY_BYTES = 200  # of a remembered run besides its characters
PAIR_BITS = 21
INDEXED = 200_000  # characters of one suffix array
BLOCK = 500_000  # characters of the texts taken together


def load(path: str):
    """The library's model; only ones that leave the text as it is, spaces apart, are taken."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.normalize(" A \ufb01  ") != f"{SPACE}{SPACE}A{SPACE}\ufb01{SPACE}{SPACE}":
        raise ValueError("the model changes texts before it encodes them")
    return model


@functools.lru_cache(maxsize=2)
def plain_bytes(path: str) -> list[bytes]:
    """What each piece stands for; control pieces stand for nothing."""
    model, out = load(path), []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        elif model.is_unknown(i):
            out.append(" ⁇ ".encode())
        else:
            out.append(b"" if model.is_control(i) or model.is_unused(i) else piece.replace(SPACE, " ").encode())
    return out


class PieceModel:
    """The pieces of a SentencePiece BPE model with byte fallback, and what follows from them."""

    def __init__(self, path: str) -> None:
        model = load(path)
        self.size = model.vocab_size()
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.bytes_id = [0] * 256
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_id[int(piece[3:5], 16)] = i
            elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
                self.rank[piece], self.id[piece] = -model.get_score(i), i
        # Pieces that merging can make, in the order of their characters, as fixed-width keys.
        made = sorted(p for p in self.id if self.merge(p) == [p])
        self.depth = max(map(len, made))
        self.pieces = np.array([self.id[p] for p in made])
        self.text = {self.id[p]: p for p in made}
        self.lengths = np.array([len(p) for p in made])
        # Characters in the order of their code points, from 2; 0 is a gap, 1 any without a piece.
        letters = sorted(set("".join(made)))
        self.code = np.ones(0x110000, dtype=">u2")
        self.code[[ord(c) for c in letters]] = np.arange(2, len(letters) + 2)
        self.low, self.high = self._keys(made, 0), self._keys(made, 0xFFFF)
        self.pair_code = np.full(1 << PAIR_BITS, -1, dtype=np.int64)
        self.pair_fits = np.zeros(1 << PAIR_BITS, dtype=bool)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.long: dict[str, bytes] = {}  # runs too long to be remembered, for the texts at hand
        self.held = 0  # bytes of what is known
        # Which characters stand side by side in some piece: a bit for each pair of codes.
        self.letters = len(letters) + 2
        self.pairs = np.zeros(self.letters**2 // 8 + 1, dtype=np.uint8)
        for piece in made:
            codes = self._codes(piece).astype(np.int64)
            both = codes[:-1] * self.letters + codes[1:]
            np.bitwise_or.at(self.pairs, both >> 3, (1 << (both & 7)).astype(np.uint8))

    def _codes(self, text: str) -> np.ndarray:
        return self.code[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")]

    def _keys(self, pieces: list[str], end: int) -> np.ndarray:
        rows = np.full((len(pieces), self.depth), end, dtype=">u2")
        for row, piece in zip(rows, pieces, strict=True):
            row[:len(piece)] = self._codes(piece)
        return rows.view(f"S{2 * self.depth}").ravel()

    def merge(self, text: str) -> list[str]:
        """Byte-pair merging as such: the pair that makes the best piece first, the left one of equals.

        Only short strings are merged: single pieces and pairs of them.
        """
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        queue: list[tuple] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts):
                both = parts[i] + parts[j]
                if both in self.rank:
                    heapq.heappush(queue, (self.rank[both], i, j, both))

        for i in range(len(parts) - 1):
            offer(i)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return ((pair * 0x9E3779B97F4A7C1) >> 20) & (len(self.pair_code) - 1)

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether pieces stay as they are when they meet; answers are kept in a table of fixed size."""
        pair = left * self.size + right
        slot = self._slot(pair)
        new = np.unique(pair[self.pair_code[slot] != pair])
        for code, at in zip(new.tolist(), self._slot(new).tolist(), strict=True):
            one, two = (self.text[x] for x in divmod(code, self.size))
            self.pair_code[at], self.pair_fits[at] = code, self.merge(one + two) == [one, two]
        out = self.pair_fits[slot]
        lost = np.flatnonzero(self.pair_code[slot] != pair)  # two pairs wanted one place
        for i in lost.tolist():
            one, two = self.text[int(left[i])], self.text[int(right[i])]
            out[i] = self.merge(one + two) == [one, two]
        return out

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All occurrences of pieces in the text: ``start``, ``end`` and id of each.

        A suffix array, sorted to the length of the longest piece, is searched for both ends of
        every piece's range.
        """
        size = len(codes)
        padded = np.concatenate([codes, np.zeros(self.depth, codes.dtype)]).astype(">u2")  # bytes sort as codes
        suffixes = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, self.depth)[:size])
        suffixes = suffixes.view(f"S{2 * self.depth}").ravel()
        array = np.argsort(suffixes, kind="stable")
        ordered = suffixes[array]
        first = np.searchsorted(ordered, self.low, side="left")
        found = np.searchsorted(ordered, self.high, side="right") - first
        at = np.repeat(first - np.cumsum(found) + found, found) + np.arange(found.sum())
        start = array[at]
        return start, start + np.repeat(self.lengths, found), np.repeat(self.pieces, found)

    def learn(self, runs: list[str]) -> None:
        """Encode runs that are not known yet, all of them side by side.

        Merging has one result, and two neighbours in it fit each other; the last piece of every
        prefix is therefore the one edge that ends there and fits the last piece before it. A
        character without a piece is spelled in bytes and fits everything.
        """
        size = np.array([len(r) for r in runs])
        stop = np.cumsum(size + 1) - 1
        begin = stop - size
        text = "\0".join(runs)
        codes = self._codes(text).astype(np.uint16)
        codes[stop[:-1]] = 0
        start, end, piece = self.edges(codes)
        depth = end - np.repeat(begin, size + 1)[start]  # place of the end in its run
        order = np.argsort(depth, kind="stable")
        start, end, piece = start[order], end[order], piece[order]
        cuts = np.searchsorted(depth[order], np.arange(1, size.max() + 2))
        last, since = np.full(len(text) + 1, -3), np.full(len(text) + 1, -1)
        last[begin] = -2
        spelled = np.flatnonzero(codes == 1)
        spelled_depth = spelled + 1 - np.repeat(begin, size + 1)[spelled]
        by_depth = np.argsort(spelled_depth, kind="stable")
        spelled = spelled[by_depth]
        spelled_cuts = np.searchsorted(spelled_depth[by_depth], np.arange(1, size.max() + 2))
        for here in range(size.max()):
            a, b = cuts[here], cuts[here + 1]
            if a < b:
                left = last[start[a:b]]
                good = left >= -2
                inner = np.flatnonzero(left >= 0)
                good[inner] = self.fits(left[inner], piece[a:b][inner])
                ends = end[a:b][good]
                last[ends], since[ends] = piece[a:b][good], start[a:b][good]
            a, b = spelled_cuts[here], spelled_cuts[here + 1]
            if a < b:
                alone = spelled[a:b][last[spelled[a:b] + 1] == -3]
                last[alone + 1], since[alone + 1] = -1, alone
        if (last[stop] == -3).any():
            raise ValueError(f"no pieces for {runs[int(np.flatnonzero(last[stop] == -3)[0])][:40]!r}")

        # Back from the ends of all runs at once.
        run, at, taken = np.arange(len(runs)), stop, []
        while len(run):
            taken.append((run, since[at], last[at]))
            at = since[at]
            more = at > begin[run]
            run, at = run[more], at[more]
        run, at, ids = (np.concatenate(x) for x in zip(*taken, strict=True))
        order = np.lexsort((at, run))
        run, at, ids = run[order], at[order], ids[order].astype("<i4")
        edge = np.searchsorted(run, np.arange(len(runs) + 1)).tolist()
        odd = set(run[ids == -1].tolist())
        for i, text in enumerate(runs):
            some = ids[edge[i]:edge[i + 1]]
            if i in odd:
                places = (at[edge[i]:edge[i + 1]] - begin[i]).tolist()
                spelled_out: list[int] = []
                for place, piece_id in zip(places, some.tolist(), strict=True):
                    spelled_out += [piece_id] if piece_id >= 0 else [self.bytes_id[b] for b in text[place].encode()]
                some = np.array(spelled_out, dtype="<i4")
            if len(text) > LONGEST_CACHED:
                self.long[text] = some.tobytes()
            else:
                self.known[text] = some.tobytes()
                self.held += ENTRY_BYTES + 8 * len(text)

    def _runs(self, texts: list[str]) -> list[list[str]]:
        """Each text in runs that no piece goes across, so each is merged on its own."""
        whole = "\0".join(texts)
        codes = self._codes(whole).astype(np.int64)
        both = codes[:-1] * self.letters + codes[1:]
        apart = (self.pairs[both >> 3] >> (both & 7).astype(np.uint8)) & 1 == 0
        cuts = np.concatenate([[0], np.flatnonzero(apart) + 1, [len(whole)]])
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes + 1) - 1
        first, last = np.searchsorted(cuts, ends - sizes), np.searchsorted(cuts, ends)
        cuts = cuts.tolist()
        return [
            [whole[a:b] for a, b in zip(cuts[i:j], cuts[i + 1:j + 1], strict=True)] if n else []
            for i, j, n in zip(first.tolist(), last.tolist(), sizes.tolist(), strict=True)
        ]

    def _make_known(self, runs: list[str]) -> None:
        """Runs used of late outlast the others when the cache is full."""
        if self.held > CACHED_BYTES:
            self.known, self.older, self.held = {}, self.known, 0
        self.long = {}
        group: list[str] = []
        size = 0
        for run in dict.fromkeys(runs):
            if run in self.known:
                continue
            if run in self.older:
                self.known[run] = self.older[run]
                self.held += ENTRY_BYTES + 8 * len(run)
                continue
            group.append(run)
            size += len(run) + 1
            if size > INDEXED:
                self.learn(group)
                group, size = [], 0
        if group:
            self.learn(group)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for block in _blocks([SPACE + t.replace(" ", SPACE) if t else "" for t in texts]):
            parts = self._runs(block)
            self._make_known([r for p in parts for r in p])
            known, long = self.known, self.long
            out += [np.frombuffer(b"".join([known[r] if r in known else long[r] for r in p]), dtype="<i4") for p in parts]
        return out


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    """Texts in blocks of about ``BLOCK`` characters, or one longer text."""
    block: list[str] = []
    size = 0
    for text in texts:
        block.append(text)
        size += len(text) + 1
        if size > BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


@functools.lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def decoded(plain: list[bytes], ids) -> str:
    return b"".join(map(plain.__getitem__, ids)).removeprefix(b" ").decode("utf-8", "replace")


def encode(text: Column, model_file: str) -> Column:
    """Piece ids of a text; a null or empty text has none.

    The words of a batch of texts are strung together and indexed by a suffix array; every
    piece's occurrences come from binary search, and going through them in order of their ends
    picks the pieces that byte-pair merging gives. Frequent words stay known for the life of
    the worker. Equal texts have equal ids. NUL characters are spelled in bytes, as are all
    characters that have no piece.
    """

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = piece_model(model_file)
        for texts in batches:
            yield pd.Series(model.encode(texts.tolist()), dtype=object)

    return run(text)


def decode(ids: Column, model_file: str) -> Column:
    """The text of piece ids: the opposite of :func:`encode`; null ids are an empty text.

    Exact for every text without the character that stands for a space in pieces, which comes
    back as a space.
    """

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        plain = plain_bytes(model_file)
        for rows in batches:
            yield pd.Series([decoded(plain, r.tolist()) if r is not None else "" for r in rows], dtype=object)

    return run(ids)


def encode_and_decode(docs: DataFrame, model_file: Callable[[], str] | str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, text, ids, decoded`` of every row: :func:`encode` and :func:`decode` in one worker, some texts at a time.

    ``model_file`` is a path or gives one; a function is called in the task, so a file may lie elsewhere there. A null text is an
    empty one. Ids may be null or repeated; other columns are not read; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = model_file if isinstance(model_file, str) else model_file()
        model, plain = piece_model(path), plain_bytes(path)
        for batch in batches:
            for piece in text_slices(batch, 1, BLOCK):
                ids = model.encode(piece.column(1).to_pylist())
                ends = np.cumsum([0, *(len(x) for x in ids)]).astype(np.int32)
                flat = np.concatenate([*ids, np.empty(0, "<i4")]).astype(np.int32)
                back = [decoded(plain, x.tolist()) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(back, pa.string())],
                    names=["id", "text", "ids", "decoded"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, text string, ids array<int>, decoded string")
    return out.select(F.col("id").alias(id_col), "text", "ids", "decoded")
