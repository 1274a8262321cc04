"""Tokens of texts from those of their pieces, with a bounded memo per worker process.

A text is cut where no tokenizer rule can reach across. Equal pieces have
equal tokens, so each piece is encoded by the library once while the memo has
room, and again each time when it has none.
"""

from __future__ import annotations

import os
import re

import numpy as np

from payloom.llm.common import kept_one

#: What one generation of a memo may take: an entry takes ENTRY bytes, those of its piece, and four for each token, of which a byte is one at most.
MEMO_BYTES = 96 << 20
ENTRY = 130
#: Longer pieces aren't remembered: they hardly come again, and a text without a cut is one piece.
LONGEST = 256
BATCH_BYTES = 256 << 10


class Memo:
    """What is known of pieces, in two generations of about ``limit`` bytes each, whatever the pieces are like.

    When the current one is full it becomes the previous one, from which pieces
    come back as they are met again; those that aren't are forgotten. So
    frequent pieces stay, whatever else a corpus brings.
    """

    def __init__(self, limit: int | None = None):
        self.limit = limit or MEMO_BYTES
        self.current: dict[bytes, object] = {}
        self.previous: dict[bytes, object] = {}
        self.bytes = 0

    def values(self, texts: list[list[bytes]], learn) -> list[list]:
        """What is known of each piece of each text; ``learn`` enters all that is new in the batch at once."""
        if self.bytes >= self.limit:
            self.previous, self.current, self.bytes = self.current, {}, 0
        known, previous = self.current, self.previous
        rows = [list(map(known.get, pieces)) for pieces in texts]
        holes = [(row, pieces, [k for k, v in enumerate(row) if v is None]) for row, pieces in zip(rows, texts, strict=True) if None in row]
        new = {pieces[k] for _, pieces, places in holes for k in places}
        back = {p: v for p in new if (v := previous.get(p)) is not None}
        before = len(known)
        known.update(back)
        learn(list(new.difference(back)))
        for row, pieces, places in holes:
            for k in places:
                row[k] = known[pieces[k]]
        for piece in [p for p in new if len(p) > LONGEST]:
            del known[piece]
            new.remove(piece)
        self.bytes += 5 * sum(map(len, new)) + max(len(known) - before, 0) * ENTRY
        return rows


def tokenizer_of(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core already
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def by_bytes(pieces: list[bytes], limit: int = BATCH_BYTES):
    """Consecutive pieces whose bytes sum to about the limit."""
    batch, size = [], 0
    for piece in pieces:
        batch.append(piece)
        size += len(piece) + 1
        if size >= limit:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


#: Words of nothing but letters whose composed lower-case form has nothing but letters.
LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: ASCII marks, which form a piece of their own behind such letters; without the apostrophe, which may begin a contraction.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordIds:
    """Ids of texts for a tokenizer that drops white space and has no rule across it.

    Words between ASCII white space are the pieces; marks behind a letter are
    pieces again. The tokenizer puts texts in lower case, so A-Z are lowered
    before the look-up. New words of letters are encoded together, without the
    steps that don't change them, and parted where tokens end a word; others are joined by a special token's text,
    which the tokenizer always takes out as one id.
    """

    def __init__(self, path: str, separator: str, word_end: str = "</w>", memo_bytes: int | None = None):
        self.tokenizer = tokenizer_of(path)
        self.separator, self.mark = separator, self.tokenizer.token_to_id(separator)
        specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, specials)))
        vocab = self.tokenizer.get_vocab()
        self.words = self._for_words(path)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(word_end)]] = True
        self.memo = Memo(memo_bytes)

    @staticmethod
    def _for_words(path: str):
        """The same tokenizer for lower-case words of letters, which its normaliser and word pattern leave as they are."""
        from tokenizers import normalizers, pre_tokenizers

        plain = tokenizer_of(path)
        plain.normalizer = normalizers.Sequence([])
        plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return plain

    def _ids(self, text: str, tokenizer=None) -> np.ndarray:
        return np.array((tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, words: list[bytes]) -> None:
        """Encode new words and enter them in the memo."""
        known = self.memo.current
        plain, odd, marked = set(), [], []
        for w in words:
            if w.isalpha() or LETTERS.fullmatch(w):
                plain.add(w)
                continue
            stem = w.rstrip(MARKS)
            if len(stem) < len(w) <= LONGEST and (stem.isalpha() or LETTERS.fullmatch(stem)):
                marked.append((w, stem, w[len(stem):]))
            else:
                odd.append(w)
        plain.update(stem for _, stem, _ in marked)
        odd += {marks for _, _, marks in marked}
        for batch in by_bytes(list(plain.difference(known)), 64 << 10):
            ids = self._ids(b" ".join(batch).decode().lower(), self.words)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(batch):
                self._part(batch, ids, np.append(0, ends[:-1]), ends)
            else:
                odd += batch
        rest = [w for w in odd if w not in known]
        for batch in by_bytes([w for w in rest if not self.special.search(w)], 64 << 10):
            ids = self._ids(self.separator.join(w.decode("utf-8", "replace") for w in batch))
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
            self._part(batch, ids, np.append(0, ends[:-1] + 1), ends)
        for w in rest:
            if w not in known:
                known[w] = self._ids(w.decode("utf-8", "replace")).tobytes()
        for w, stem, marks in marked:
            known[w] = known[stem] + known[marks]

    def _part(self, words: list[bytes], ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw, known = ids.tobytes(), self.memo.current
        for word, a, z in zip(words, (4 * starts).tolist(), (4 * ends).tolist(), strict=True):
            known[word] = raw[a:z]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        # Special texts are told by case: a text that may hold one is left as it is.
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        return [b"".join(ids) for ids in self.memo.values(split, self._learn)]


#: A blank or line break between characters that are surely no white space: no byte-level BPE rule spans it.
SAFE_CUT = re.compile(rb"(?:(?<=[!-~])|(?<=[\xc3-\xdf][\x80-\xbf]))([ \n])(?=[!-~\xc3-\xdf])")


class PieceLengths:
    """Token counts of texts for byte-level BPE whose pieces begin at single blanks.

    A blank belongs to the piece after it, a line break is a piece of its own.
    """

    def __init__(self, path: str, window: int):
        self.tokenizer, self.window = tokenizer_of(path), window
        self.memo = Memo()
        self.line_break = len(self.tokenizer.encode("\n", add_special_tokens=False).ids)

    def windows(self, text: bytes):
        """The text in parts of about `window` bytes, each cut at a safe boundary; uncut where there is none."""
        at = 0
        while len(text) - at > self.window:
            cut = SAFE_CUT.search(text, at + self.window)
            if cut is None:
                break
            yield text[at:cut.start(1)]
            at = cut.start(1)
        yield text[at:]

    def _pieces(self, part: bytes) -> tuple[list[bytes], int]:
        found = SAFE_CUT.split(part)
        marks = found[1::2]
        pieces = [b" " + p if m == b" " else p for m, p in zip(marks, found[2::2], strict=True)]
        pieces.append(found[0])
        return pieces, marks.count(b"\n") * self.line_break

    def count(self, texts: list[bytes]) -> list[int]:
        """Numbers of tokens; texts are taken in groups of about `window` bytes."""
        totals = [0] * len(texts)
        group, size = [], 0
        for k, text in enumerate(texts):
            for part in self.windows(text):
                group.append((k, part))
                size += len(part)
                if size >= self.window:
                    self._add(group, totals)
                    group, size = [], 0
        self._add(group, totals)
        return totals

    def _add(self, group: list[tuple[int, bytes]], totals: list[int]) -> None:
        cut = [(k, *self._pieces(part)) for k, part in group]
        counts = self.memo.values([pieces for _, pieces, _ in cut], self._learn)
        for (k, _, breaks), own in zip(cut, counts, strict=True):
            totals[k] += sum(own) + breaks

    def _learn(self, pieces: list[bytes]) -> None:
        for batch in by_bytes(pieces):
            encoded = self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in batch], add_special_tokens=False)
            self.memo.current.update(zip(batch, map(len, encoded), strict=True))


def memo_of(kind, *args):
    """One memo for its kind and file in a worker process, used by all its tasks until they need another."""
    return kept_one((kind, *args), lambda: kind(*args))
