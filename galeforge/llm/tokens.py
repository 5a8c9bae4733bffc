"""Byte-level BPE ids of whole texts with the tokenizers library, each distinct part of a text encoded once."""

from __future__ import annotations

import os

import numpy as np
import regex

from .common import release

#: A space before anything but white space and control characters: there a new piece always begins.
_ODD_SPACE, _CUT = regex.compile(r" (?![^\p{Z}\p{C}])"), regex.compile(r" (?=[^\p{Z}\p{C}])")
#: Characters below this are classed alike by every regular expression library.
_LATIN = "ɐ"
#: Stands between pieces that are encoded in one call; parts that hold it are encoded alone.
_BETWEEN = "\x00"
#: Characters worked on at once, about; longest part that is kept; parts kept at most, and ids for each of these.
_BLOCK, _LONGEST, _PARTS, _IDS = 500_000, 1024, 500_000, 16
#: Kinds of bytes; any other is 0.
_LETTER, _DIGIT, _SIGN, _QUOTE, _WHITE = range(1, 6)
#: UTF-8 lead bytes of U+00C0 to U+023F, which are letters but for × and ÷.
_LEADS = range(0xC3, 0xC9)


def _kinds() -> np.ndarray:
    """The kind of each byte that is a whole character."""
    kind = lambda c: _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _WHITE if c in "\t\n\r" else _QUOTE if c == "'" else _SIGN if "!" <= c <= "~" else 0
    return np.array([kind(chr(b)) for b in range(128)] + [0] * 128, np.uint8)


def _ends() -> np.ndarray:
    """At 6 * kind + kind of the next character, whether a piece always ends between them: quotes may begin "'s", signs go with quotes, and white space needs more than its neighbour."""
    out = np.zeros((6, 6), bool)
    out[[_LETTER, _DIGIT, _SIGN], 1:] = True
    np.fill_diagonal(out, False)
    out[_SIGN, _QUOTE] = False
    return out.ravel()


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, the rest from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Table:
    """Id lists by a part's 64-bit hash, and 32 bits of another to check it: a large sorted run, and a small one of what came since. Rows, ends and ids are kept as short as they allow."""

    def __init__(self, ids: type = np.uint32):
        self.runs = [(np.zeros(0, np.uint64), np.zeros(0, np.int32))] * 2  # sorted hashes, and their rows
        self.n, self.check, self.end, self.ids = 0, np.zeros(0, np.uint32), np.zeros(1, np.int32), np.zeros(0, ids)
        self.hits = np.zeros(0, np.uint16)  # blocks that held a part, as far as 16 bits go

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 for new ones."""
        out = np.full(len(hashes), -1, np.int32)
        for keys, rows in self.runs:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[at] == hashes
                out[hit] = rows[at[hit]]
        return out

    def add(self, hashes: np.ndarray, check: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        rows, first = np.arange(self.n, self.n + len(sizes), dtype=np.int32), int(self.end[self.n])
        self.check, self.hits = self._room(self.check, self.n, check), self._room(self.hits, self.n, np.zeros(len(sizes), np.uint16))
        self.ids = self._room(self.ids, first, ids)
        self.end = self._room(self.end, self.n + 1, (first + np.cumsum(sizes)).astype(np.int32))
        self.n += len(sizes)
        large, small = self.runs
        small = self._sorted(np.concatenate([small[0], hashes]), np.concatenate([small[1], rows]))
        if len(small[0]) * 4 > len(large[0]):
            large, small = self._sorted(np.concatenate([large[0], small[0]]), np.concatenate([large[1], small[1]])), (small[0][:0], small[1][:0])
        self.runs = [large, small]
        return rows

    @staticmethod
    def _room(x: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
        """x with ``more`` after its first n values; if there is no room, in an array that is a quarter larger."""
        if n + len(more) > len(x):
            old, x = x, np.empty(n + max(n // 4, len(more)), x.dtype)  # what is never written takes no memory
            x[:n] = old[:n]
        x[n : n + len(more)] = more
        return x

    @staticmethod
    def _sorted(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        by = np.argsort(keys, kind="stable")
        return keys[by], rows[by]

    def keep(self, n: int) -> None:
        """Keep the n rows of the parts met most often, the earlier of equals."""
        stay = np.sort(np.argsort(-self.hits[: self.n].astype(np.int64), kind="stable")[:n])
        number = np.full(self.n, -1, np.int32)
        number[stay] = np.arange(len(stay), dtype=np.int32)
        self.ids, size = self.gather(stay)
        self.n, self.check, self.hits, self.end = len(stay), self.check[stay], self.hits[stay], np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        keys, rows = (np.concatenate(x) for x in zip(*self.runs, strict=True))
        rows = number[rows]
        self.runs = [self._sorted(keys[rows >= 0], rows[rows >= 0]), (keys[:0], rows[:0])]

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these rows one after another, and how many each has."""
        size = self.end[rows + 1] - self.end[rows]
        after = np.cumsum(size, dtype=np.int64)
        return self.ids[np.repeat(self.end[rows] - (after - size), size) + np.arange(after[-1] if len(after) else 0)], size


class Encoder:
    """Encodes texts exactly as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    The tokenizer's pattern begins a new piece at every space that stands before a printed character, and ends one between letters, digits, signs and
    line ends (see ``_starts``), so a text's ids are those of its parts between such places in a row; a word has the same part whatever sign follows it. Parts are found by two independent
    hashes, of 64 and 32 bits, taken over all bytes of a block at once; new ones are cut by the pattern and their pieces encoded together in one call. The table is
    cut to half beyond ``most`` parts or _IDS ids for each of these, which bounds memory and changes no id. A text of over a block is cut at such spaces, so
    memory doesn't grow with it unless it has none. Stretches with other spacing or very long
    parts go to the library whole, as do parts beyond Latin letters or with special tokens.
    """

    def __init__(self, path: str, most: int = _PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.between_id = self.tokenizer.token_to_id(self.letters[0])
        self.pieces_only = Tokenizer.from_file(path)  # the same merges over pieces that are already cut and spelt in byte letters
        self.pieces_only.pre_tokenizer = pre_tokenizers.Split(self.letters[0], "isolated")
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.most, self.table = most, _Table(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        rng = np.random.default_rng(7)
        self.kinds, self.ends = _kinds(), _ends()
        self.plain = np.isin(np.arange(256), [*range(0x21, 0x7F), *_LEADS])  # bytes that begin a printed character; others may
        self.weights = [rng.integers(1, 1 << 64, _LONGEST + 1, np.uint64).astype(kind) | kind(1) for kind in (np.uint64, np.uint32)]
        self.values = [np.arange(1, 257, dtype=w.dtype) for w in self.weights]  # of each byte

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i in range(0, len(pieces), 20_000):
            spelt = _BETWEEN.join(pieces[i : i + 20_000]).encode().decode("latin-1").translate(self.letters)
            got = np.array(self.pieces_only.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, np.uint32)
            cut = got == self.between_id
            sizes.append(np.diff(np.concatenate([[-1], np.flatnonzero(cut), [len(got)]])) - 1)
            ids.append(got[~cut])
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new parts one after another, and how many each has."""
        pieces: list[str] = []
        counts: list[int] = []
        whole: dict[int, np.ndarray] = {}
        find, latin = self.pattern.findall, _LATIN
        for text in parts:
            word = text[1:] if text[0] == " " else text
            if word.isalpha() and (word.isascii() or max(word) < latin):
                pieces.append(text)
                counts.append(1)
                continue
            if (text.isascii() or max(text, default="") < latin) and _BETWEEN not in text and not any(t in text for t in self.special):
                found = find(text)
                pieces += found
                counts.append(len(found))
            else:
                whole[len(counts)] = self._whole(text)
                counts.append(0)
        ids, size = self._encode_pieces(pieces)
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *counts])]
        sizes = np.diff(ends)
        for n, x in sorted(whole.items(), reverse=True):
            ids = np.concatenate([ids[: ends[n]], x, ids[ends[n] :]])
            sizes[n] = len(x)
        return ids, sizes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, uint32."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held, owners, chars = [], [], 0
        for k, text in enumerate(texts):
            at = 0
            while at < len(text) or not at:
                cut = _CUT.search(text, at + _BLOCK) if len(text) - at > _BLOCK else None
                end = cut.start() if cut else len(text)
                held.append(text[at:end])
                owners.append(k)
                chars += end - at
                if chars >= _BLOCK:
                    for n, ids in zip(owners, self._block(held), strict=True):
                        out[n].append(ids)
                    held, owners, chars = [], [], 0
                if end == len(text):
                    break
                at = end
        for n, ids in zip(owners, self._block(held), strict=True):
            out[n].append(ids)
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def _starts(self, data: np.ndarray, docs: np.ndarray, special: np.ndarray | None) -> np.ndarray:
        """Where the parts of these bytes begin: at the texts' starts (docs), at spaces, and, but in bytes marked as special, where a piece always ends between two characters of known kinds.

        Of white space before another character the last is a piece by itself: it is cut off if what precedes it is known too.
        """
        first = np.zeros(len(data) + 2, bool)
        first[docs] = True
        kind = self.kinds[data]
        lead = np.flatnonzero((data >= _LEADS[0]) & (data <= _LEADS[-1]))
        lead = lead[(data[lead] > 0xC3) | ((data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7))]
        kind[lead] = kind[lead + 1] = _LETTER
        out = first[: len(data)].copy()
        out[1:] |= self.ends[kind[:-1] * np.uint8(6) + kind[1:]]
        white = np.flatnonzero(kind[:-1] == _WHITE)  # before a known character that is not white
        white = white[(kind[white + 1] > 0) & (kind[white + 1] != _WHITE) & ~first[white + 1]]
        more = white[white > 0]
        out[more] |= kind[more - 1] == _WHITE
        out[white[out[white]] + 1] = True
        if special is not None:
            out &= ~special
        return np.flatnonzero(out | (data == 32) | first[: len(data)])

    def _block(self, held: list[str]) -> list[np.ndarray]:
        """The ids of stretches of text."""
        if self.table.n > self.most or self.table.end[self.table.n] > _IDS * self.most:
            self.table.keep(min(self.most, self.table.n) // 2)
            release()
        raws = [text.encode() for text in held]
        size = np.array([len(x) for x in raws], np.int64)
        raw = b"".join(raws)
        del raws
        if not raw:
            return [np.zeros(0, np.uint32) for _ in held]
        data = np.frombuffer(raw, np.uint8)
        last = np.cumsum(size)
        docs = (last - size)[size > 0]
        special = None
        if any(t.encode() in raw for t in self.special):
            special = np.repeat([any(t in text for t in self.special) for text in held], size)
        starts = self._starts(data, docs, special)
        ends = np.append(starts[1:], len(data))
        gone = starts[ends - starts > _LONGEST]  # bytes in texts that the library takes whole, for their long parts or for their spacing
        space = np.flatnonzero(data == 32)
        doubt = space[~self.plain[data[np.minimum(space + 1, len(data) - 1)]] | np.isin(space + 1, last)]
        odd = {int(k) for k in np.unique(np.searchsorted(last, doubt, side="right")) if _ODD_SPACE.search(held[k])} | set(np.searchsorted(last, gone, side="right").tolist())
        if odd:
            others = iter(self._block([text for k, text in enumerate(held) if k not in odd]))
            return [self._whole(text) if k in odd else next(others) for k, text in enumerate(held)]
        place = np.arange(len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), ends - starts)

        def sums(weights, values):
            weighed = weights[place]
            weighed *= values[data]
            return np.add.reduceat(weighed, starts, dtype=weights.dtype)

        own, check = map(sums, self.weights, self.values)
        del place
        distinct, first, back = np.unique(own, return_index=True, return_inverse=True)
        rows = self.table.find(distinct)
        new = np.flatnonzero(rows < 0)
        if len(new):
            at = first[new]
            ids, sizes = self._learn([raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            rows[new] = self.table.add(distinct[new], check[at], ids, sizes)
        self.table.hits[rows] += self.table.hits[rows] < 0xFFFF
        rows = rows[back]
        ids, size = self.table.gather(rows)
        wrong = self.table.check[rows] != check  # two parts with one hash: their texts are encoded whole
        bad = set(np.searchsorted(last, starts[wrong], side="right").tolist()) if wrong.any() else ()
        cut = np.append(0, np.cumsum(size))[np.searchsorted(starts, last)].tolist()
        return [self._whole(text) if k in bad else ids[a:b].astype(np.uint32) for k, (text, a, b) in enumerate(zip(held, [0, *cut], cut, strict=False))]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget_encoders() -> None:
    """For tasks that encode nothing: the worker's encoders and their parts go."""
    _encoders.clear()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
