"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes for what patterns miss.

The field labels every token of every line. It is trained from the small labelled table below, which also shows it the pattern
kinds and look-alikes (versions, years, amounts, identifiers, plain words after cue words). It adds credentials, national
identity numbers, and items of the pattern kinds that are written in another way. A span of the patterns always stays; an
added one that touches it is dropped. A word's spelling counts only for the cue words of the table, so that all other words share a few
sets of features, whose scores are computed once.

Every row is judged by itself: one pass, no shuffle.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pitframe.llm import crf
from pitframe.llm.shingles import chunks

# The patterns.
EMAIL_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_RIGHT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

KINDS = ("email", "ip", "card", "phone")
ADDED = ("national_id", "secret")
OUTSIDE = 0
LABELS = ("outside", *(f"{where}-{kind}" for kind in KINDS + ADDED for where in ("first", "more")))
FEATURES = 1 << 13
RESULT = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, "
          "n_national_id bigint, n_secret bigint, n_spans bigint")
CHUNK_BYTES = 2_000_000

TOKEN = re.compile(r"[^\s=\"',;:()<>\[\]]+|=")
#: Whether a code point parts tokens; none beyond U+3000 does.
PARTS_TOKENS = np.array([chr(c).isspace() or chr(c) in "\"',;:()<>[]" for c in range(0x3001)] + [False])
STEPS = (-2, -1, 1)  # neighbours that a token's features name
CAPITAL = re.compile("[A-Z]")
TOKEN_KINDS = ("plain", "digits", "mixed")


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping ``left@right``, searched from each at sign, so a long run without one costs nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LEFT:
            start -= 1
        right = EMAIL_RIGHT.match(text, at + 1) if start < at else None
        if right:
            yield start, right.end()
            free = right.end()
        at = text.find("@", max(at + 1, free))


def _octet(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four patterns, leftmost and non-overlapping per kind, ordered by kind and start."""
    found = []
    found += [("email", a, b) for a, b in emails(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


@dataclass
class Tokens:
    """The tokens of some texts: places in the joined texts, the word table, and the lines that hold any."""

    begin: np.ndarray
    end: np.ndarray
    words: list[str]
    word: np.ndarray  # of each token, a place in ``words``
    lengths: np.ndarray  # tokens of each line
    owner: np.ndarray  # text of each line
    text_begin: np.ndarray  # where each text starts in the joined ones


def tokens_of(texts: list[str]) -> Tokens:
    """What TOKEN finds in every line, without a Python object per token: the code points as one array, the distinct words by Arrow."""
    code = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    sign = code == ord("=")
    inside = ~(PARTS_TOKENS[np.minimum(code, 0x3001)] | sign)
    begin = np.flatnonzero((inside & ~np.r_[False, inside[:-1]]) | sign)
    end = np.flatnonzero((inside & ~np.r_[inside[1:], False]) | sign) + 1
    used = code[inside | sign]
    width = 1 + (used >= 0x80).astype(np.int32) + (used >= 0x800) + (used >= 0x10000)  # bytes in UTF-8
    offsets = np.r_[0, np.cumsum(width)][np.r_[0, np.cumsum(end - begin)]].astype(np.int32)
    data = used.tobytes().decode("utf-32-le").encode()
    words = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    line = np.searchsorted(np.flatnonzero((code == 10) | (code == 13)), begin)
    first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]]) if len(line) else np.empty(0, np.int64)
    text_begin = np.r_[0, np.cumsum([len(t) + 1 for t in texts])][:-1]
    return Tokens(begin, end, words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(np.r_[first, len(line)]),
                  np.searchsorted(text_begin, begin[first], side="right") - 1, text_begin)


def shape(token: str) -> str:
    return re.sub(r"(.)\1{2,}", r"\1\1\1", re.sub("[^\\W\\d_]", "x", re.sub("[0-9]", "9", re.sub("[A-Z]", "X", token[:24]))))


def _own(token: str) -> list[str]:
    digits = sum(c.isdigit() for c in token)
    letters = sum(c.isalpha() for c in token)
    kind = "plain" if not digits and "@" not in token else "digits" if not letters else "mixed"
    return [
        kind, f"shape={shape(token)}", f"length={min(len(token) // 4, 8)}", f"digits={min(digits, 20)}",
        f"hex={bool(re.fullmatch('[0-9a-f]{16,}', token))}", f"capitals={bool(re.fullmatch('[A-Z0-9]{16,}', token))}",
        f"at={'@' in token}", f"dots={min(token.count('.'), 4)}", f"dashes={min(token.count('-'), 4)}", f"plus={token[0] == '+'}",
    ]


@lru_cache(maxsize=1 << 16)
def _number(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little") % FEATURES


@lru_cache(maxsize=1 << 18)
def _seen(token: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """A token's own feature names (its kind first), and what it is to its neighbours: kind, sign or (for cue words) spelling."""
    own = _own(token)
    spelling = token.lower()[:10]
    seen = [own[0], own[1] if own[0] != "plain" else spelling if spelling in CUES else "word"]
    return tuple(own), tuple(seen + ["equals"] if token == "=" else seen)


def features(tokens: list[str]) -> list[list[int]]:
    """Feature numbers of each token: its own shape, and what its neighbours are, alone and with its own kind."""
    seen = [_seen(t) for t in tokens]
    result = []
    for i, (own, _) in enumerate(seen):
        around = [f"{step}:{n}" for step in STEPS for n in (seen[i + step][1] if 0 <= i + step < len(tokens) else ("edge",))]
        result.append([_number(n) for n in ("bias", *own, *around, *(f"{own[0]}&{n}" for n in around))])
    return result


class Scores:
    """Emission scores of tokens as sums of what the token has by itself and what each neighbour gives to a token of its kind."""

    def __init__(self, model: crf.Model):
        self.weights = model.weights
        self.rows: dict[tuple, int] = {}
        self.simple: dict[tuple, int] = {}
        self.kinds: list[int] = []
        self.own: list[np.ndarray] = []
        self.given: list[np.ndarray] = []  # step x kind x label
        self.edge = self._row((("plain",), ("edge",)))

    def _row(self, seen: tuple) -> int:
        row = self.rows.get(seen)
        if row is None:
            row = self.rows[seen] = len(self.own)
            own, names = seen
            self.kinds.append(TOKEN_KINDS.index(own[0]))
            self.own.append(self.weights[[_number(n) for n in ("bias", *own)]].sum(0))
            self.given.append(np.array([[self.weights[[_number(n) for s in names for n in (f"{step}:{s}", f"{kind}&{step}:{s}")]].sum(0) for kind in TOKEN_KINDS] for step in STEPS]))
        return row

    def _row_of(self, token: str) -> int:
        """The row of a token. Short words of letters have one row for each length, kind of first letter and last sign, save cue words."""
        tail = token[-1] if token[-1] in ".!?" else ""
        body = token[:-1] if tail else token
        if len(token) >= 16 or not body.isalpha() or CAPITAL.search(body, 1):
            return self._row(_seen(token))
        spelling = token.lower()[:10]
        key = (len(token), "A" <= token[0] <= "Z", tail, spelling if spelling in CUES else "")
        row = self.simple.get(key)
        if row is None:
            row = self.simple[key] = self._row(_seen(token))
        return row

    def of(self, tokens: list[str], lengths: np.ndarray) -> np.ndarray:
        """Scores of the tokens of all sequences, one after another."""
        distinct = sorted(set(tokens))
        number = {t: i for i, t in enumerate(distinct)}
        return self.of_words(distinct, np.array([number[t] for t in tokens], np.int64), lengths)

    def of_words(self, words: list[str], word: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if len(self.own) > 50_000:
            self.__init__(crf.Model(self.weights, None, None))
        row = np.array([self._row_of(t) for t in words], np.int64)[word]
        kind, own, given = np.array(self.kinds)[row], np.array(self.own), np.array(self.given)
        place = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        length = np.repeat(lengths, lengths)
        score = own[row]
        for k, step in enumerate(STEPS):
            inside = (place + step >= 0) & (place + step < length)
            score += given[np.where(inside, np.roll(row, -step), self.edge), k, kind]
        return score


# The labelled table: each line is words with marked spans, {kind} standing for a value of that kind made by a rule, and
# {look-alike} for one that is none. Words are invented, so that the model leans on shapes and cue words.
LINES = (
    "w w {email} w w", "w w w {email}", "contact {email} w", "w w {ip} w w", "{ip} w w", "w w {card} w w", "card {card} w", "w w {phone} w w",
    "call {phone} w w", "w {secret_hex} w w", 'token = "{secret_hex}" w w', 'w w token = "{secret_hex}"', "w password={secret_short} w w", "password={secret_short} w",
    "w w {secret_key} w w", "{secret_key} w w", "w w {secret_key}", "api_key = {secret_hex} w", "secret: {secret_short} w w", "key={secret_key} w w", "pwd: {secret_short} w",
    "ssn {national_id} w w", "w ssn: {national_id} w", "social security number {national_id} w", "w w {national_id} w w",
    "w w {year} w w", "version {version} w w", "w w Version {version}. w", "w {amount} w w", "w w {number} w w w", "CC BY-NC {version}. w", "w {ordinal} w w w",
    "w {long_number} w w", "order {long_number} w w", "http://w.example.com/en/{number}?page={number}", "w w {part} w w", "w {date} w w", "w, {number}, {number}, {number} w", "w {range} w w",
    "w w w w w", "token w w {number} w", "the password w w {year} w", "w w key w {number} w",
    "password={secret_words} w w", "w w password={secret_words}", "password = {secret_words} w", "w passwd={secret_letters} w", "password: {secret_words} w w", "pwd: {secret_letters} w", "secret={secret_words} w",
    "w api_key={secret_letters} w", "token={secret_letters} w w", 'passphrase = "{secret_words}" w', "w secret: {secret_letters}",
    "call {phone_local} w w", "w w phone {phone_local} w", "tel {phone_local} w", "w w {phone_local} w w", "w w w w {phone_local}", "fax: {phone_local} w w",
    "w w w w w w w w w w w w", "W w w, w w. W w w w", "the password w w w w", "w password. W w w", "the key w w w", "w secret w w w", "w token w w w", "w w phone w w", "call w w w w", "tel w w w", "w w passphrase w w",
    "w w-w w w w", "w w-w-w w w w", "w, w: w w-w w", "w = w w w", "w w=w w", "password w-w w w", "w w w w.w w w", "WW w w w", "w wW w w",
)
CUES = frozenset(token.lower()[:10] for line in LINES for token in TOKEN.findall(re.sub(r"\{\w+\}|\bw+\b", " ", line, flags=re.IGNORECASE)))


def _value(kind: str, rng: random.Random) -> str:
    def pick(alphabet: str, n: int) -> str:
        return "".join(rng.choice(alphabet) for _ in range(n))

    digits, low, high = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return {
        "email": lambda: f"{pick(low, rng.randint(2, 8))}.{pick(digits, 2)}@{pick(low, 5)}{rng.randint(1, 9)}.example.com",
        "ip": lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)),
        "card": lambda: "4" + pick(digits, 15),
        "phone": lambda: rng.choice((f"+1 ({pick(digits, 3)}) 555-{pick(digits, 4)}", f"+{pick(digits, 2)} {pick(digits, 3)} {pick(digits, 6)}")),
        "secret_hex": lambda: pick("0123456789abcdef", rng.choice((32, 40, 40, 48, 64))),
        "secret_short": lambda: pick("0123456789abcdef", rng.randint(10, 20)) + rng.choice(digits),
        "secret_key": lambda: "AKIA" + pick(high + digits, 16),
        "secret_words": lambda: rng.choice("---_.").join(pick(low, rng.randint(3, 8)) for _ in range(rng.randint(2, 4))),
        "secret_letters": lambda: rng.choice((pick(low + high, rng.randint(10, 24)), pick(low + high + "!#$%&*-_", rng.randint(10, 20)))),
        "phone_local": lambda: rng.choice((f"({pick(digits, 3)}) {pick(digits, 3)}-{pick(digits, 4)}", f"{pick(digits, 3)}-{pick(digits, 3)}-{pick(digits, 4)}", f"{pick(digits, 3)}.{pick(digits, 3)}.{pick(digits, 4)}")),
        "national_id": lambda: f"{pick(digits, 3)}-{pick(digits, 2)}-{pick(digits, 4)}",
        "year": lambda: str(rng.randint(1900, 2030)),
        "version": lambda: f"{rng.randint(0, 9)}.{rng.randint(0, 9)}",
        "amount": lambda: f"{rng.randint(1, 999)},{pick(digits, 3)}.{pick(digits, 2)}",
        "number": lambda: pick("123456789", rng.randint(1, 5)),
        "ordinal": lambda: f"{rng.randint(1, 99)}th",
        "long_number": lambda: pick(digits, rng.randint(6, 20)),
        "part": lambda: f"{pick(high, 2)}-{pick(digits, 4)}",
        "date": lambda: f"{rng.randint(1, 31):02d}-{rng.randint(1, 12):02d}-{rng.randint(1950, 2030)}",
        "range": lambda: f"{rng.randint(1, 50)}-{rng.randint(51, 99)}",
    }[kind]()


def labelled_table(copies: int = 12, seed: int = 7) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(text, spans) rows; each line of LINES several times with other words and values."""
    rng = random.Random(seed)
    rows = []
    for line in LINES:
        for _ in range(copies):
            text, spans = "", []
            for piece in re.split(r"(\{\w+\}|\bw\b|\bW+\b|\bwW\b)", line):
                if piece in ("w", "W", "WW", "wW"):
                    form = {"W": str.capitalize, "WW": str.upper, "wW": lambda t: t + t.capitalize()}.get(piece, str)
                    text += form("".join(rng.choice(("an", "the", "on", "re", "ti", "ou", "é", "sch", "ción")) for _ in range(rng.randint(1, 4))))
                elif piece.startswith("{"):
                    kind, value = piece[1:-1], _value(piece[1:-1], rng)
                    name = kind.split("_")[0] if kind.startswith(("secret", "phone")) else kind
                    if name in KINDS + ADDED:
                        spans.append((name, len(text), len(text) + len(value)))
                    text += value
                else:
                    text += piece
            rows.append((text, spans))
    return rows


def _encoded(sequences: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    tokens = [t for s in sequences for t in s]
    sizes = np.array([len(t) for t in tokens])
    return np.concatenate([np.array(t) for t in tokens]), np.cumsum(sizes) - sizes, np.array([len(s) for s in sequences])


def trained(rows=None) -> crf.Model:
    sequences, gold = [], []
    for text, spans in rows if rows is not None else labelled_table():
        places = [m.span() for m in TOKEN.finditer(text)]
        sequences.append(features([text[a:b] for a, b in places]))
        open_span = None
        for a, b in places:
            inside = next((s for s in spans if s[1] <= a and b <= s[2]), None)
            gold.append(OUTSIDE if inside is None else LABELS.index(f"{'more' if inside == open_span else 'first'}-{inside[0]}"))
            open_span = inside
    return crf.train(*_encoded(sequences), np.array(gold), FEATURES, len(LABELS))


def _possible(kind: str, item: str) -> bool:
    """Whether an item can be of the kind at all."""
    digits = re.sub("[^0-9]", "", item)
    return {
        "email": lambda: "@" in item, "ip": lambda: bool(IP.fullmatch(item)) and all(map(_octet, item.split("."))),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 7 <= len(digits) <= 15,
    }.get(kind, lambda: True)()


def undecided(model: crf.Model, score: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The lines whose best path can hold another label than OUTSIDE.

    A path that leaves OUTSIDE gains, for each token with another label, at most the difference of the scores, of the best way into that
    label and of the way back. Where that is negative for every label of every token, all OUTSIDE is the best path, and Viterbi need not run.
    """
    stay = model.transitions[OUTSIDE, OUTSIDE]
    into = model.transitions.max(axis=0) - stay
    first = model.initial - model.initial[OUTSIDE]
    back = np.maximum(model.transitions[:, OUTSIDE] - stay, 0)
    others = np.arange(score.shape[1]) != OUTSIDE
    gain = (score[:, others] + (np.maximum(into, first) + back)[others]).max(axis=1) - score[:, OUTSIDE]
    begin = np.cumsum(lengths) - lengths
    return np.flatnonzero(np.maximum.reduceat(gain, begin) >= -1e-9)


def added_spans(texts: list[str], base: list[list[tuple[str, int, int]]], model: crf.Model, kinds: tuple[str, ...] = ADDED, scores: Scores | None = None) -> list[list[tuple[str, int, int]]]:
    """Spans of ``kinds`` in each text that touch none of ``base``, by one Viterbi call over the lines that can hold any."""
    result: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    t = tokens_of(texts)
    if not len(t.begin):
        return result
    score = (scores or Scores(model)).of_words(t.words, t.word, t.lengths)
    begin = np.cumsum(t.lengths) - t.lengths
    open_lines = undecided(model, score, t.lengths)
    if not len(open_lines):
        return result
    lengths = t.lengths[open_lines]
    own = np.cumsum(lengths) - lengths
    token = np.arange(lengths.sum()) + np.repeat(begin[open_lines] - own, lengths)
    labels = crf.decode(model, score[token], lengths)
    for at in np.flatnonzero(np.add.reduceat(labels != OUTSIDE, own)).tolist():
        owner = int(t.owner[open_lines[at]])
        text, origin = texts[owner], t.text_begin[owner]
        of = token[own[at]: own[at] + lengths[at]]
        spans: list[list] = []
        last = ""
        for a, b, label in zip((t.begin[of] - origin).tolist(), (t.end[of] - origin).tolist(), labels[own[at]: own[at] + lengths[at]].tolist(), strict=True):
            where, _, kind = LABELS[label].partition("-")
            if kind in kinds:
                if where == "more" and last == kind:
                    spans[-1][2] = b
                else:
                    spans.append([kind, a, b])
            last = kind
        for kind, a, b in spans:
            while b > a + 1 and text[b - 1] in ".!?":
                b -= 1
            if kind == "phone" and a and text[a - 1] == "(" and ")" in text[a:b]:
                a -= 1
            if _possible(kind, text[a:b]) and all(b <= x or y <= a for _, x, y in base[owner]):
                result[owner].append((kind, a, b))
    return [sorted(set(r)) for r in result]


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """By kind as listed, then by place."""
    return sorted(spans, key=lambda s: ((KINDS + ADDED).index(s[0]), s[1:]))


def _text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def find(docs: DataFrame, model: crf.Model | None = None) -> DataFrame:
    """One row per input row: doc_id, the counts by pattern, the digest of the pattern spans, all spans, and how many national numbers,
    credentials and spans of any kind there are.

    A null text counts as empty and has no spans. Repeated rows are scanned one by one; an empty table gives an empty result;
    columns other than doc_id and text are not read.
    """
    model = model or trained()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(model)
        for batch in batches:
            for part in chunks(batch, CHUNK_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                base = [base_spans(t) for t in texts]
                more = added_spans(texts, base, model, KINDS + ADDED, scores)
                counts = [pa.array([sum(s[0] == kind for s in spans) for spans in base], pa.int64()) for kind in KINDS]
                digests = pa.array([hashlib.sha256(_text(spans).encode()).hexdigest() for spans in base])
                every = [in_order(b + m) for b, m in zip(base, more, strict=True)]
                added = [pa.array([sum(s[0] == kind for s in spans) for spans in more], pa.int64()) for kind in ADDED]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *counts, digests, pa.array(map(_text, every), pa.string()), *added, pa.array(map(len, every), pa.int64())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", *(f"n_{k}" for k in ADDED), "n_spans"])

    return docs.select("doc_id", "text").mapInArrow(scan, RESULT)
