"""SentencePiece encoding and decoding for merge-type vocabularies.

Symbols start as characters. An agenda holds each adjacent pair whose union is a piece, best score first, leftmost among
equals; the best pair is merged and the pairs with its new neighbours join the agenda, until it is empty. Symbols that
are no piece fall back to their bytes. No piece goes on behind a space mark, so a text is encoded word by word, and a
word's encoding is kept for its next occurrence. Every new word of an Arrow batch is checked against the sentencepiece
library, and so is one whole text of each batch. A word's ids are decoded once; a text whose words all come back as they
were is its own decoded form.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import col, held, sealed, unsealed

MARK = "▁"
KEPT, PORTION = 400_000, 2_000_000
SHORT = 24
STRANGE, NEVER = 0xFFFF, 1 << 62
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PieceEncoder:
    """Encoder and decoder over the vocabulary of a model file. The file has to be readable on every worker."""

    def __init__(self, path: str, check: bool = True, kept: int = KEPT):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, self.check, self.kept = self.library, check, kept
        n = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in range(n) if lib.is_control(i)}
        self.scores = {self.pieces[i]: (lib.get_score(i), i) for i in range(n) if not (lib.is_control(i) or lib.is_byte(i) or lib.is_unknown(i) or lib.is_unused(i))}
        self.id_of = {p: i for p, (_, i) in self.scores.items()}
        self.plain = [p.replace(MARK, " ") for p in self.pieces]
        self.letters = {p: i for p, (_, i) in self.scores.items() if len(p) == 1}
        # For every way to cut a piece in two: (ids of the parts) -> (rank of its score, its id). Ranks need unlike scores.
        merged = [p for p in self.scores if p.strip(MARK)]  # runs of marks alone share one score: such words take the heap
        unlike = len({self.scores[p][0] for p in merged}) == len(merged) and n < STRANGE
        order = sorted(merged, key=lambda p: -self.scores[p][0]) if unlike else []
        pairs = {self.id_of[a] << 16 | self.id_of[b]: rank << 16 | self.id_of[p] for rank, p in enumerate(order) for k in range(1, len(p)) if (a := p[:k]) in self.id_of and (b := p[k:]) in self.id_of}
        self.keys = np.array(sorted(pairs), np.int64)
        self.entries = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        if any(MARK in p.lstrip(MARK) for p in self.scores):
            raise ValueError("the vocabulary has a piece that goes on behind a space mark")
        self.bos, self.eos, self.unknown = lib.bos_id(), lib.eos_id(), lib.unk_id()
        # Words whose ids are known, those known before, and the decoded form of words that do not come back as they are.
        self.memo: dict[str, bytes] = {}
        self.past: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}
        self.length = np.array([len(p) for p in self.plain], np.int64)
        self.simple = np.array([i not in self.byte_of and i not in self.silent and i != lib.unk_id() for i in range(n)])

    def merge(self, word: str) -> list[int]:
        """The ids of a word whose spaces are marks."""
        return self.merged([word])[0].tolist()

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many words in a row, and how many each has. Words of one length share an agenda: a row for each word,
        an entry for each adjacent pair.

        An entry is the rank of the union's score and the union's id in one number; in every row the least and leftmost
        is merged, and its neighbours are looked up anew, until a row has none. Long words and runs of marks (whose pieces
        share one score) go one by one.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        single = sizes > SHORT if len(self.keys) else np.ones(len(words), bool)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters, place = np.unique(codes, return_inverse=True)
        known, top = [self.letters.get(chr(c), -1) for c in letters.tolist()], len(self.pieces)
        strange = [c for c, i in zip(letters.tolist(), known, strict=True) if i < 0]  # no pieces: numbered behind the pieces, and merge with nothing
        number = iter(range(top, top + len(strange)))
        ids_of = np.array([i if i >= 0 else next(number) for i in known], np.int64)[place]
        begins, mark = np.cumsum(sizes) - sizes, self.letters.get(MARK, STRANGE)
        if top + len(strange) > STRANGE:
            single[:] = True
        for n in np.unique(sizes[~single]).tolist():
            rows = np.flatnonzero(~single & (sizes == n))
            ids = ids_of[begins[rows][:, None] + np.arange(n)]
            odd = ((ids[:, 1:] == mark) & (ids[:, :-1] == mark)).any(axis=1)
            single[rows[odd]] = True
            rows, ids = rows[~odd], ids[~odd]
            agenda = self._find(ids[:, :-1], ids[:, 1:])
            while len(rows):
                best = agenda.min(axis=1) if agenda.shape[1] else np.full(len(rows), NEVER)
                over = best == NEVER
                if over.any():
                    done.append((rows[over], ids[over]))
                    rows, ids, agenda, best = rows[~over], ids[~over], agenda[~over], best[~over]
                    if not len(rows):
                        break
                m, row = ids.shape[1], np.arange(len(rows))
                i = agenda.argmin(axis=1)
                new = best & 0xFFFF
                ids[row, i] = new
                ids = ids[np.arange(m) != i[:, None] + 1].reshape(len(rows), m - 1)
                agenda = agenda[np.arange(m - 1) != i[:, None]].reshape(len(rows), m - 2)
                left, right = np.flatnonzero(i > 0), np.flatnonzero(i < m - 2)
                agenda[left, i[left] - 1] = self._find(ids[left, i[left] - 1], new[left])
                agenda[right, i[right]] = self._find(new[right], ids[right, i[right] + 1])
        done += [(np.array([r]), np.array([self.merge_long(words[r])], np.int64)) for r in np.flatnonzero(single).tolist()]
        counts = np.zeros(len(words), np.int64)
        for rows, ids in done:
            counts[rows] = ids.shape[1]
        begins, flat = np.cumsum(counts) - counts, np.zeros(counts.sum(), np.int64)
        for rows, ids in done:
            flat[begins[rows][:, None] + np.arange(ids.shape[1])] = ids
        odd = np.flatnonzero(flat >= top)
        if len(odd):
            instead = [self._ids([chr(c)]) for c in strange]
            lengths = np.ones(len(flat), np.int64)
            lengths[odd] = np.array([len(x) for x in instead])[flat[odd] - top]
            owner = np.repeat(np.arange(len(words)), counts)
            counts = np.bincount(owner, lengths, len(words)).astype(np.int64)
            wide = np.repeat(flat, lengths)
            wide[np.repeat(flat >= top, lengths)] = [k for i in flat[odd].tolist() for k in instead[i - top]]
            flat = wide
        return flat.astype(np.uint32), counts

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 16) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.entries[at], NEVER)

    def merge_long(self, word: str) -> list[int]:
        """With the agenda as a heap and the symbols as a linked list."""
        symbols = list(word)
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        agenda: list[tuple[float, int, int, int]] = []

        def suggest(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (found := self.scores.get(symbols[a] + symbols[b])):
                heapq.heappush(agenda, (-found[0], a, b, len(symbols[a]) + len(symbols[b])))

        for i in range(len(symbols) - 1):
            suggest(i, i + 1)
        while agenda:
            _, a, b, size = heapq.heappop(agenda)
            if not symbols[a] or not symbols[b] or after[a] != b or len(symbols[a]) + len(symbols[b]) != size:
                continue  # one of the two has been merged since
            symbols[a] += symbols[b]
            symbols[b] = ""
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            suggest(before[a], a)
            suggest(a, after[a])
        return self._ids(symbols)

    def _ids(self, symbols: list[str]) -> list[int]:
        if None not in (quick := list(map(self.id_of.get, symbols))):
            return quick
        out = []
        for s in symbols:
            if s:
                found = self.scores.get(s)
                out += [found[1]] if found else [self.bytes[b] for b in s.encode()] if self.bytes else [self.unknown]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, as the library's decode gives it: runs of byte pieces as UTF-8, the first blank dropped."""
        out, run, started = [], bytearray(), False

        def flush() -> None:
            at = 0
            while at < len(run):
                try:
                    out.append(run[at:].decode())
                    break
                except UnicodeDecodeError as e:
                    out.append(run[at : at + e.start].decode() + "�")
                    at += e.start + 1
            run.clear()

        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                started = True
                continue
            flush()
            if i in self.silent:
                continue
            piece = " ⁇ " if i == self.unknown else self.pieces[i].replace(MARK, " ")
            if not started:
                piece = piece[1:] if piece.startswith(" ") and i != self.unknown else piece
            started = True
            out.append(piece)
        flush()
        return "".join(out)

    def _learn(self, fresh: list[str]) -> None:
        flat, counts = self.merged(fresh)
        ends = np.cumsum(counts)
        begins = ends - counts
        if self.check:
            self._compare(fresh, flat, begins, ends)
        raw = flat.astype("<u4").tobytes()
        self.memo.update(zip(fresh, [raw[a:b] for a, b in zip((begins * 4).tolist(), (ends * 4).tolist(), strict=True)], strict=True))
        # Words of plain pieces are decoded together: equal texts and equal lengths word by word make equal words.
        plain = np.ones(len(fresh), bool)
        plain[np.repeat(np.arange(len(fresh)), counts)[~self.simple[flat]]] = False
        lengths = np.bincount(np.repeat(np.arange(len(fresh)), counts), self.length[flat], len(fresh))
        plain &= lengths == np.fromiter(map(len, fresh), np.int64, len(fresh))
        same = [w for w, p in zip(fresh, plain.tolist(), strict=True) if p]
        if "".join([self.plain[i] for i in flat[np.repeat(plain, counts)].tolist()]) != "".join(same).replace(MARK, " "):
            plain[:] = False
        for k in np.flatnonzero(~plain).tolist():
            decoded = "".join(self._plain(flat[begins[k] : ends[k]].tolist()))
            if decoded != fresh[k].replace(MARK, " "):
                self.odd[fresh[k]] = decoded

    def _compare(self, words: list[str], flat: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        """Hold the ids of every word against the library's: a thousand words in a row, as no piece goes over a space."""
        rows = [k for k, w in enumerate(words) if w[-1] != MARK]
        parts = [rows[i : i + 1000] for i in range(0, len(rows), 1000)] + [[k] for k, w in enumerate(words) if w[-1] == MARK and len(w) > 1]
        texts = ["".join([words[k] for k in part]).replace(MARK, " ")[1:] for part in parts]
        for part, other in zip(parts, self.library.encode(texts, num_threads=1), strict=True):
            mine = np.concatenate([flat[begins[k] : ends[k]] for k in part]) if len(part) > 1 and part[-1] - part[0] >= len(part) else flat[begins[part[0]] : ends[part[-1]]]
            if not np.array_equal(mine, np.array(other, np.uint32)):
                for k in part:
                    if flat[begins[k] : ends[k]].tolist() != self.library.encode(words[k][1:].replace(MARK, " ")):
                        raise AssertionError(f"encoding differs from the library's for a word of {len(words[k])} characters: {words[k][:60]!r}")
                raise AssertionError(f"encoding differs from the library's for {len(part)} words in a row")

    def _plain(self, ids: list[int]) -> list[str]:
        """A word's decoded parts, its first blank kept; the byte pieces of one word make up whole characters."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
            else:
                out += [run.decode("utf-8", "replace"), self.plain[i]]
                run = bytearray()
        return [*out, run.decode("utf-8", "replace")]

    def encode_batch(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """For each text its ids with begin and end, as little-endian unsigned 32-bit numbers, and the decoded text."""
        begin, end = np.array([self.bos], "<u4").tobytes(), np.array([self.eos], "<u4").tobytes()
        ids: list[bytes] = []
        decoded: list[str] = []
        at = 0
        while at < len(texts):
            split, size = [], 0
            while at < len(texts) and size < PORTION:
                t = texts[at]
                split.append(_WORD.findall(MARK + t.replace(" ", MARK)) if t else [])
                size += len(t)
                at += 1
            if len(self.memo) > self.kept:  # what has not been met since the last time is forgotten
                self.past, self.memo = self.memo, {}
                self.odd = {w: x for w, x in self.odd.items() if w in self.past}
            know, past = self.memo, self.past
            fresh = set().union(*split) - know.keys()
            met = fresh & past.keys()
            know.update({w: past[w] for w in met})
            if fresh := list(fresh - met):
                self._learn(fresh)
            odd = self.odd
            for t, words in zip(texts[at - len(split) : at], split, strict=True):
                ids.append(b"".join([begin, *map(know.__getitem__, words), end]))
                if odd and not odd.keys().isdisjoint(words):
                    decoded.append("".join([odd[w] if w in odd else w.replace(MARK, " ") for w in words])[1:])
                else:
                    decoded.append(t.replace(MARK, " "))
        if self.check and texts:
            whole = min(range(len(texts)), key=lambda i: abs(len(texts[i]) - 1000))
            other = self.library.encode(texts[whole], add_bos=True, add_eos=True)
            if np.array(other, "<u4").tobytes() != ids[whole] or self.library.decode(other) != decoded[whole]:
                raise AssertionError(f"encoding differs from the library's for a text of {len(texts[whole])} characters: {texts[whole][:60]!r}")
        return ids, decoded


def encode_pieces(docs: DataFrame, model_path: str, text_col: str = "text", check: bool = True, kept: int = KEPT) -> DataFrame:
    """docs with token_ids (binary: little-endian unsigned 32-bit, begin and end included), n_tokens and decoded.

    A null text is empty: begin and end only, decoded to ''. Texts of any length are encoded whole. An empty table gives
    an empty table; input columns named like an output give way to it. model_path is opened once in each worker,
    which keeps the ids of about kept words twice, those met lately and those before.
    """

    @F.arrow_udf("struct<token_ids binary, decoded string>")
    def encode(text: pa.Array) -> pa.Array:
        encoder = held(f"pieces-{check}-{kept}-{model_path}", lambda: PieceEncoder(model_path, check, kept))
        ids, decoded = encoder.encode_batch([t or "" for t in text.to_pylist()])
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], ["token_ids", "decoded"])

    rows = sealed(docs, text=col(text_col)).withColumn("out", encode("text"))
    return unsealed(rows, docs.columns, token_ids=F.col("out.token_ids"), n_tokens=(F.octet_length("out.token_ids") / 4).cast("long"), decoded=F.col("out.decoded"))
