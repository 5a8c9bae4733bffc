"""PII: fixed formats, and boosted trees over the overlapping spans that high-recall generators propose."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_row, share_of, table

#: The first four have a fixed format; secrets are found by the method alone.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
#: Cards and phones: numbers whose proposals differ in where they begin and end.
NUMBERS = (2, 3)
#: Documents that any candidates are learnt from, about, and as many again that hold a value of a kind, for each kind; values of a kind in one
#: document, and rows of a kind, that are learnt from at most; trees, depth, rate, bins; least precision of what a threshold lets through.
SAMPLE_DOCS, KIND_VALUES, KIND_ROWS = 3000, 8, 12_000
TREES, DEPTH, RATE, BINS, PRECISION = 40, 3, 0.2, 16, 0.98
#: What every value of a kind matches, for Spark.
HOLDS = (r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+\.[A-Za-z0-9-]", r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", r"[0-9]([\x20-]?[0-9]){11}", r"\+[0-9][\x20().0-9-]+[0-9]")
#: Characters around a candidate that its context features see, and around a mark that an address candidate may take.
AROUND, REACH = 40, 64
SEED = 8

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
#: A match that fails from the first digit of a run fails from every later one, so only run starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches of the address pattern, found from each @: linear in the text."""
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and not _NOT_LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed formats, leftmost and non-overlapping for each kind, in order."""
    out = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdecimal() for c in m[0]) <= 15]
    return sorted(out)


#: Generators: the kind, and what it may look like beyond its fixed format. Addresses are found around a mark that stands for @. Numbers are looked for
#: from every digit that no digit precedes, as one may stand among others; the last generator of cards takes one separator throughout and ends with it.
_AT = re.compile(r"@|\s?[(\[{]at[)\]}]\s?| at ", re.I)
_BEFORE = re.compile(r"[\w.+-]{1,64}\Z")
_AFTER = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\s?[(\[{]dot[)\]}]\s?| dot )[A-Za-z0-9-]{1,63}){1,5}", re.I)
_MORE = (
    (1, re.compile(r"(?<![\w.])\d{1,3}(?: ?\. ?\d{1,3}){3}(?![\w.])")),
    (1, re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![\w:])")),
    (2, re.compile(r"(?<!\d)(?=(\d(?:[ ._/-]{0,2}\d){11,18})(?!\d))")),
    (3, re.compile(r"(?<![\w+])(?=((?:00\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3}[ .-]\d{3,4})(?!\d))")),
    (4, re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,512}={0,2}(?![A-Za-z0-9+/_=-])")),
    (2, re.compile(r"(?<!\d)(?=(\d{4}([ ._/-]{1,3})\d{3,6}(?:\2\d{1,6}){1,3})(?!\d))")),
)


def candidates(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, generator) of everything the generators propose; spans may overlap."""
    out = []
    for m in _AT.finditer(text):
        before, after = _BEFORE.search(text[max(0, m.start() - REACH) : m.start()]), _AFTER.match(text, m.end())
        if before and after:
            out.append((m.start() - len(before[0]), 0, after.end(), 0))
    if _DIGIT.search(text):
        for g, (kind, pattern) in enumerate(_MORE, 1):
            out += [(m.start(), kind, m.end(1 if kind in NUMBERS else 0), g) for m in pattern.finditer(text) if kind != 4 or _mixed(m[0])]
    return sorted(out)


def _mixed(s: str) -> bool:
    return any(c.isdigit() for c in s) and any(c.isalpha() for c in s)


#: Words that stand near each kind of data, and near what only looks like it. Fixed values.
CONTEXT = (
    ("mail", "email", "contact", "write", "courriel", "correo"),
    ("ip", "host", "server", "address", "adresse"),
    ("card", "visa", "credit", "payment", "carte", "karte", "tarjeta"),
    ("phone", "tel", "call", "mobile", "fax", "telefon"),
    ("version", "release", "isbn", "order", "id", "no", "serial", "date", "page"),
    ("token", "secret", "key", "apikey", "password", "passwd", "pwd", "auth", "bearer", "credential"),
    ("hash", "commit", "sha", "md", "checksum", "digest", "uuid", "file", "image", "path"),
)
FEATURES = 24 + len(CONTEXT)


_ASSIGNED = re.compile(r"[a-z_]\s*[=:]\s*[\"']?\Z")
_NUMBER_BEFORE, _NUMBER_AFTER = re.compile(r"\d[ ._/-]{1,3}\Z"), re.compile(r"[ ._/-]{1,3}\d")


def features(text: str, start: int, kind: int, end: int, generator: int) -> list[float]:
    """Of a candidate's format and of what stands around it."""
    s = text[start:end]
    digits = "".join(c for c in s if c.isdecimal())
    rest = [c for c in s if not c.isalnum()]
    numbers = re.findall(r"\d+", s)
    before, after = text[max(0, start - AROUND) : start].lower(), text[end : end + AROUND].lower()
    near = re.findall(r"[^\W\d_]+", before) + re.findall(r"[^\W\d_]+", after)[:3]
    return [
        kind, generator, len(s), len(digits), len(rest), len(set(rest)), sum(c.isalpha() for c in s), len(numbers), max(map(len, numbers), default=0), float(luhn(digits)) if 12 <= len(digits) <= 19 else -1.0,
        sum(int(n) <= 255 for n in numbers if len(n) < 6), float(s[:1] == "0"), s.count("."), float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "#=:\"'$"),
        len(set(s)) / len(s), sum(c in "0123456789abcdefABCDEF" for c in s) / len(s), sum(c.isupper() for c in s) / len(s), sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:])) / len(s), float(bool(_ASSIGNED.search(before))),
        float(bool(_NUMBER_BEFORE.search(before[-4:]))), float(bool(_NUMBER_AFTER.match(after))), len({len(n) for n in numbers[:-1]}),
        *(float(any(w in group for w in near)) for group in CONTEXT),
    ]


@dataclass
class Boosted:
    """Depth-wise trees on binned features, fitted to the logistic loss; each tree is (feature, bin) for each inner node and a value for each leaf."""

    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    base: float = 0.0
    thresholds: list[float] = field(default_factory=lambda: [2.0] * len(KINDS))

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def _leaf(self, b: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        node = np.zeros(len(b), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        return node - (2**DEPTH - 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        b = self._bins(x)
        p = min(0.99, max(0.01, y.mean()))
        self.base = float(np.log(p / (1 - p)))
        z = np.full(len(y), self.base)
        for _ in range(TREES):
            q = 1 / (1 + np.exp(-z))
            g, h = y - q, q * (1 - q)
            feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, BINS)
            node = np.zeros(len(y), np.int64)
            for level in range(DEPTH):
                for k in range(2**level - 1, 2 ** (level + 1) - 1):
                    rows = np.flatnonzero(node == k)
                    best = 1e-6
                    for j in range(x.shape[1]) if len(rows) else ():
                        n = len(self.edges[j]) + 1
                        gs, hs = np.bincount(b[rows, j], g[rows], n).cumsum(), np.bincount(b[rows, j], h[rows], n).cumsum()
                        gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                        if gain.max() > best:
                            best, feature[k], cut[k] = float(gain.max()), j, int(gain.argmax())
                node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
            leaf = node - (2**DEPTH - 1)
            value = RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)
            z += value[leaf]
            self.trees.append((feature, cut, value))
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        b, z = self._bins(x), np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            z += value[self._leaf(b, feature, cut)]
        return 1 / (1 + np.exp(-z))


def _invented(kind: int, rng: np.random.Generator) -> str:
    """A value of a kind's fixed format at random; of secrets, random letters and digits."""
    d = lambda n: f"{rng.integers(10**n):0{n}d}"
    w = lambda: "".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(3, 9)))
    if kind == 0:
        return f"{w()}{rng.choice(['.', '_', ''])}{w()}@{w()}.{rng.choice(['com', 'org', 'net', 'de'])}"
    if kind == 1:
        return ".".join(str(rng.integers(0, most)) for most in rng.choice([12, 100, 256], 4))
    if kind == 2:
        head = d(15)
        return next(head + str(k) for k in range(10) if luhn(head + str(k)))
    if kind == 3:
        return f"+{rng.integers(1, 99)} {d(10)}"
    letters = str(rng.choice(["0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]))
    return "a1" + "".join(rng.choice(list(letters), rng.integers(18, 62)))


def _disguised(kind: int, s: str, rng: np.random.Generator) -> list[tuple[str, int]]:
    """A true value in other formats (label 1), and look-alikes of its kind (label 0)."""
    digits = "".join(c for c in s if c.isdecimal())
    d = lambda n: f"{rng.integers(10**n):0{n}d}"
    if kind == 4:
        w = lambda: "".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(4, 9)))
        name = str(rng.choice(["token", "secret", "api_key", "password", "TOKEN", "auth_token", "client_secret", "access-key"]))
        hexes = "".join(rng.choice(list("0123456789abcdef"), 40))
        return [
            (f'{name} = "{s}"', 1), (f"{name}: {s}", 1), (f"{name}='{s}'", 1), (f"Bearer {s}", 1),
            (f"{w()}-{w()}-{d(2)}-{w()}", 0), (f"{w()}/{w()}/{w()}_{d(4)}", 0), (f"{d(4)}-{d(2)}-{d(2)}T{d(2)}-{d(2)}-{d(2)}", 0), (f"commit {hexes}", 0), (f"sha1: {hexes}", 0), (f"{w()}{w()}{w()}{d(2)}", 0),
        ]
    if kind == 0:
        local, _, domain = s.partition("@")
        return [(f"{local} [at] {domain.replace('.', ' [dot] ')}", 1), (f"{local} at {domain.replace('.', ' dot ')}", 1), (f"look at {local.split('.')[0]}.{domain.split('.')[0]}", 0)]
    if kind == 1:
        return [(s.replace(".", " . "), 1), (":".join(f"{rng.integers(0, 65536):x}" for _ in range(8)), 1), (".".join(str(rng.integers(256, 999)) for _ in range(4)), 0), (":".join(f"{rng.integers(0, 60):02d}" for _ in range(4)), 0)]
    if kind == 2:
        # lists of numbers that are no cards, though their check digit is right
        lists = (f"{d(3)} {d(2)}.{d(1)} 20{d(2)}-{d(2)}-{d(2)}" for _ in range(99)), (f"{d(2)}.{d(3)} {d(1)} {d(5)}/{d(3)}" for _ in range(99))
        lucky = [next((x for x in many if luhn("".join(c for c in x if c.isdecimal()))), d(14)) for many in lists]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + rng.integers(0, 8)) % 10)
        return [*((mark.join(re.findall(".{1,4}", digits)), 1) for mark in (".", "/", str(rng.choice([" - ", "_", " . "])))), (wrong, 0), (d(14), 0), (d(4) + "." + d(12), 0), *((x, 0) for x in lucky)]
    local = digits[-10:]
    return [(f"({local[:3]}) {local[3:6]}-{local[6:]}", 1), (f"{local[:3]}-{local[3:6]}-{local[6:]}", 1), (f"00{digits[:-10] or '1'} {local[:3]} {local[3:6]} {local[6:]}", 1), (f"{d(4)}.{d(3)}-{d(3)}", 0), (f"{d(3)} {d(3)} {d(3)} {d(3)}"[: rng.integers(11, 16)], 0), (d(2) + "." + d(3) + " " + d(4), 0)]


def passes(kind: int, s: str) -> bool:
    """Whether a generator's find passes its kind's own checks, its format aside: it may well be a true value."""
    digits = "".join(c for c in s if c.isdecimal())
    if kind == 0:
        plain = re.sub(r"\s?[(\[{]dot[)\]}]\s?| dot ", ".", re.sub(r"\s?[(\[{]at[)\]}]\s?| at ", "@", s, count=1, flags=re.I), flags=re.I)
        return any(True for _ in _emails(plain))
    if kind == 1:
        numbers = re.findall(r"\d+", s) if ":" not in s else []
        return s.count(":") == 7 or len(numbers) == 4 and all(int(x) <= 255 for x in numbers)
    if kind == 4:
        return len(set(s)) >= 10 and sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:])) >= 4
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def documents_by_kind(docs: DataFrame) -> list[int]:
    """How many of all documents hold a value of each kind."""

    def start():
        def make(x):
            held = [{k for _, k, _ in base_spans(t)} for t in x["text"]]
            return {name: [int(k in h) for h in held] for k, name in enumerate(BASE_KINDS)}

        return make

    some = docs.where(F.col("text").rlike("|".join(HOLDS)))
    row = per_row(some, ["text"], start, {k: "int" for k in BASE_KINDS}, ()).agg(*[F.sum(k).alias(k) for k in BASE_KINDS]).first()
    return [row[k] or 0 for k in BASE_KINDS]


def learn(docs: DataFrame, most: int = SAMPLE_DOCS, kind_rows: int = KIND_ROWS) -> Boosted:
    """Trees and thresholds from the candidates of a sample chosen by hash: about ``most`` of all documents, and for each kind about ``most`` of all documents that hold a value of it.

    No labels of personal data are given, so they come from the formats: values that pass their checks are written again in other
    formats where they stood, and invented values of every kind, secrets among them, at random places of the sample's texts (1). Look-alikes put in their place, as well
    as the generators' other finds that fail their kind's checks, are negatives (0), and so are finds of another kind where a value stands and finds of a number that
    take in less or more than it. Of a kind,
    KIND_VALUES of a document's values and ``kind_rows`` rows are used at most. A third is kept back; a kind's threshold is the lowest whose finds there are right in PRECISION
    of the cases, counting one wrong more, half way to the next score below.
    """
    n, held = docs.count(), documents_by_kind(docs)
    # by hash of the kind's name and the id; a kind of few documents takes all of them
    part = [(F.pmod(F.xxhash64(F.lit(name), "doc_id"), F.lit(1 << 30)) < F.lit(int(min(1.0, most / max(1, c)) * (1 << 30)))) & F.col("text").rlike(h) for name, c, h in zip(BASE_KINDS, held, HOLDS, strict=True)]
    anyway = share_of("doc_id", most / n) if n > most else F.lit(True)
    chosen = docs.where(F.length("text") > 0).select("doc_id", "text", anyway.alias("anyway"), *[p.alias(name) for p, name in zip(part, BASE_KINDS, strict=True)])
    chosen = chosen.where(" or ".join(["anyway", *BASE_KINDS])).repartition(docs.sparkSession.sparkContext.defaultParallelism)  # bounded, and slow to look at: by all cores

    def start():
        def make(x):
            out = []
            for doc, text, all_of_it, *own in zip(x["doc_id"], x["text"], x["anyway"], *(x[k] for k in BASE_KINDS), strict=True):
                rng, rows, taken = np.random.default_rng([SEED, abs(doc or 0)]), [], [0] * len(KINDS)
                base = base_spans(text)
                if not all_of_it and not any(own[k] for _, k, _ in base):
                    out.append(b"")
                    continue

                def put(a, k, b, choices, before=""):
                    head, tail = text[max(0, a - AROUND) : a] + before, text[b : b + AROUND]
                    for s, label in choices:
                        made, begin, end = head + s + tail, len(head), len(head) + len(s.rstrip())
                        for c in candidates(made):
                            if c[0] < end and c[2] > begin and (label or c[1] == k):
                                right = label and c[1] == k and (k not in NUMBERS or (c[0], c[2]) == (begin, end))
                                rows.append((*features(made, *c), float(right)))

                for a, k, b in base:
                    taken[k] += 1
                    if own[k] and taken[k] <= KIND_VALUES:
                        put(a, k, b, _disguised(k, text[a:b], rng))
                if all_of_it:
                    for k in range(len(KINDS)):
                        at = text.find(" ", int(rng.integers(0, len(text)))) + 1
                        choices = _disguised(k, _invented(k, rng), rng)
                        yes, no = [c for c in choices if c[1]], [c for c in choices if not c[1]]
                        after_number = f"{rng.integers(1000)} " if k in NUMBERS and rng.integers(3) == 0 else ""
                        put(at, k, at, [(s + " ", label) for s, label in (yes[rng.integers(len(yes))], no[rng.integers(len(no))])], after_number)
                other, taken_by = [0] * len(KINDS), Taken()
                for a, _, b in base:
                    taken_by.add(a, b)
                for c in candidates(text):
                    if other[c[1]] < KIND_VALUES and not passes(c[1], text[c[0] : c[2]]) and taken_by.free(c[0], c[2]):
                        other[c[1]] += 1
                        rows.append((*features(text, *c), 0))
                out.append(np.array(rows, "<f8").tobytes())
            return {"rows": out}

        return make

    got = sorted(per_row(chosen, ["doc_id", "text", "anyway", *BASE_KINDS], start, {"rows": "binary"}).where(F.length("rows") > 0).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["rows"]))
    model = Boosted()
    if not got:
        return model
    data = np.concatenate([np.frombuffer(r["rows"], "<f8").reshape(-1, FEATURES + 1) for r in got])
    rng = np.random.default_rng(SEED)
    data = data[rng.permutation(len(data))]
    data = data[np.sort(np.concatenate([np.flatnonzero(data[:, 0] == k)[:kind_rows] for k in range(len(KINDS))]))]
    x, y = data[:, :-1], data[:, -1]
    if y.min() == y.max():
        return model
    back = np.arange(len(data)) % 3 == 0
    model.fit(x[~back], y[~back])
    p = model.probability(x[back])
    for kind in range(len(KINDS)):
        own = x[back][:, 0] == kind
        order = np.argsort(-p[own], kind="stable")
        right = np.cumsum(y[back][own][order])
        good = np.flatnonzero((right / (np.arange(len(order)) + 2) >= PRECISION) & (p[own][order] >= 0.5))
        if len(good):
            least, below = np.append(p[own][order], 0.0)[good[-1] :][:2]
            model.thresholds[kind] = max(0.5, float(least + below) / 2)
    return model


class Taken:
    """Stretches of a text that are taken; finding whether one is free takes a search, however many there are."""

    def __init__(self):
        self.begin: list[int] = []
        self.end: list[int] = []

    def free(self, a: int, b: int) -> bool:
        k = bisect_left(self.begin, b)
        return k == 0 or self.end[k - 1] <= a

    def add(self, a: int, b: int) -> None:
        """Stretches that overlap become one."""
        i, j = bisect_left(self.end, a), bisect_right(self.begin, b)
        self.begin[i:j], self.end[i:j] = [min([a, *self.begin[i : i + 1]]) if i < j else a], [max([b, *self.end[j - 1 : j]]) if i < j else b]


def find_spans(text: str, model: Boosted) -> tuple[list, list]:
    """Base spans, and those with what the trees add: by probability, none over a base span or another addition."""
    base, taken = base_spans(text), Taken()
    found = candidates(text) if model.trees else []
    for a, _, b in base if found else ():
        taken.add(a, b)
    found = [c for c in found if taken.free(c[0], c[2])]
    if not found:
        return base, base
    p = model.probability(np.array([features(text, *c) for c in found], float))
    added: list[tuple[int, int, int]] = []
    for i in np.argsort(-p, kind="stable"):
        a, kind, b, _ = found[i]
        if p[i] >= model.thresholds[kind] and taken.free(a, b):
            taken.add(a, b)
            added.append((a, kind, b))
    return base, sorted(base + added)


def written(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans: list) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, of the first's kind."""
    out, at = [], 0
    for a, kind, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, model: Boosted, keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str, str] = ("base_spans", "spans", "redacted")) -> DataFrame:
    """The kept columns of every row of (doc_id, text), base_spans and spans (or what ``names`` calls them; kind:start:end in code points, end exclusive, by start then kind), and redacted text.

    A null text is an empty one and stays null when redacted; repeated rows are searched each; an empty table gives an empty result.
    """

    def start():
        def make(x):
            found = [find_spans(t or "", model) for t in x["text"]]
            return dict(zip(names, ([written(b) for b, _ in found], [written(s) for _, s in found], [t and redact(t, s) for t, (_, s) in zip(x["text"], found, strict=True)]), strict=True))

        return make

    return per_row(docs, ["text"], start, dict.fromkeys(names, "string"), keep)


def op8_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = find_personal_data(docs, learn(docs))
    count = lambda k, c: F.regexp_count(c, F.lit(f"{k}:[0-9]+:")).cast("long")
    base = [count(k, "base_spans").alias(f"n_{k}") for k in BASE_KINDS]
    return out.select("doc_id", *base, F.sha2("base_spans", 256).alias("base_sha256"), "spans", count("secret", "spans").alias("n_secret"), count("", "spans").alias("n_spans"))
