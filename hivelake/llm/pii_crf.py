"""Personal data: fixed patterns, and a linear-chain conditional random field for what has no fixed form.

The patterns find emails, IP addresses, card numbers and phone numbers.  The field reads tokens by their
shape, length, the share of digits and the words around them, and adds secrets (passwords, keys, tokens),
phone numbers without a country code, social security numbers and IBANs.  It is trained by maximum likelihood
from a small labelled table, and decoded by Viterbi for many sequences at once.

A token may get a label if it has a digit, stands behind a word that announces a secret, or is written like a
key; a token without a digit can only be a secret.  Sequences are runs of tokens of a line around such tokens,
with the tokens before them, also those of the lines before; everything else would decode to no label and is
skipped.  Spans of the field that overlap a pattern's span are dropped.

Cases: null and empty texts have no spans.  Repeated rows and rows without an id are searched each.  An empty
table gives an empty result.  Positions are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATTERN_KINDS = ("email", "ip", "card", "phone")
FIELD_KINDS = ("secret", "phone", "ssn", "iban")
KINDS = ("email", "ip", "card", "phone", "secret", "ssn", "iban")

Span = tuple[int, int, str]  # start, end, kind

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Possessive, so that long runs of digits take linear time; they match what the plain forms match.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_LINE = re.compile(r"[^\n]+")
_SOME = re.compile("[0-9]|[A-Za-z+/_-]{16}")


def _emails(text: str) -> Iterator[Span]:
    """From each ``@`` to the left and to the right, in linear time."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last, "email"
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    """All spans of the fixed patterns, by start and then kind."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGITS.findall(m[0])) <= 15:
                    found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# the field

TAGS = ("O", *(f"{side}-{kind}" for kind in FIELD_KINDS for side in "BI"))
_TAG = {t: i for i, t in enumerate(TAGS)}
#: Words that announce a kind.
CUES = {
    "secret": ("password", "passwd", "pwd", "token", "secret", "key", "apikey", "api_key", "access_key", "credential", "auth", "bearer"),
    "ssn": ("ssn", "social", "security"),
    "iban": ("iban", "account", "konto", "cuenta", "compte"),
    "phone": ("phone", "tel", "call", "mobile", "telefon", "teléfono", "téléphone"),
}
#: What may be a cue of a secret, so that few words are looked at closely.
_MAYBE_CUE = re.compile("(?i)pass|pwd|token|secret|key|credential|auth|bearer")
#: Letters alone that are written like a key: a known prefix, hexadecimals, or a long run with capitals inside.
_KEY = re.compile(r"(?:AKIA|ASIA)[A-Z]{12,}|(?:ghp_|sk-|xox)[A-Za-z_-]{12,}|[a-f]{16,}|[A-F]{16,}|(?=[a-z+/_-]*+(?:[A-Z]++[a-z+/_-]++){3})[A-Za-z+/_-]{20,}")
#: Texts that may hold any of all this.
_WORTH = "[0-9@]|(?i:pass|pwd|token|secret|key|credential|auth|bearer)|[A-Za-z+/_-]{16}"
#: Tokens from a cue to its secret, at most.
REACH = 3
_CUE_OF = {w: kind for kind, words in CUES.items() for w in words}
_LETTERS = re.compile(r"[^\W\d]+")
_HEX = re.compile(r"[0-9a-f]{12,}|[0-9A-F]{12,}")
_SHAPES = str.maketrans({**{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "9" for c in "0123456789"}})
_RUNS = re.compile(r"(.)\1+")
CONTEXT = 4


def shape(token: str, *, full: bool = False) -> str:
    """``a`` for lower-case letters, ``A`` for capitals, ``9`` for digits; runs are one unless ``full``."""
    mapped = "".join("a" if ord(c) > 127 and c.isalpha() else c for c in token.translate(_SHAPES))
    return mapped[:16] if full else _RUNS.sub(r"\1", mapped)[:12]


def _cue(token: str) -> str:
    words = _LETTERS.findall(token.lower().replace("_", ""))
    return next((_CUE_OF[w] for w in words if w in _CUE_OF), "")


def _said(tokens: Sequence[str], i: int) -> str:
    """The kind that the nearest cue before a token announces, and whether a colon or equals sign leads to the token."""
    for j in range(i - 1, max(-1, i - 1 - REACH), -1):
        if kind := _cue(tokens[j]):
            return kind + "=" * (tokens[i - 1][-1:] in ":=")
    return ""


def token_features(tokens: Sequence[str], i: int) -> list[str]:
    token = tokens[i]
    core = token.strip("\"'.,;:()")
    value = core.rpartition("=")[2].strip("\"'")
    digits = sum(c in "0123456789" for c in value)
    before, before2 = (tokens[i - 1] if i else "^"), (tokens[i - 2] if i > 1 else "^")
    out = [
        "bias",
        f"shape={shape(core)}",
        f"size={min(len(value), 40) // 4}",
        f"full={shape(core, full=True)}" if len(core) <= 15 else "long",
        f"digits={min(4, 4 * digits // max(1, len(value)))}",
        f"hex={bool(_HEX.fullmatch(value))}",
        f"own={_cue(core.partition('=')[0]) if '=' in core else '-'}",
        f"cue-1={_cue(before)}",
        f"said={_said(tokens, i)}{len(value) >= 10}" if not digits else "said",
        f"key={bool(_KEY.fullmatch(value))}",
        f"cue-2={_cue(before2)}{before[:1] if before[:1] in '=:' else ''}",
        f"shape-1={shape(before)}",
        f"shape+1={shape(tokens[i + 1]) if i + 1 < len(tokens) else '$'}",
    ]
    if value[:4] in ("AKIA", "ASIA", "ghp_") or value[:3] in ("sk-", "xox"):
        out.append("prefix=key")
    return out


def has_digit(token: str) -> bool:
    return bool(_DIGITS.search(token))


def _secret_cue(token: str) -> bool:
    return bool(_MAYBE_CUE.search(token)) and _cue(token) == "secret"


def may_hold(tokens: Sequence[str], i: int) -> bool:
    """Whether a token may get a label."""
    token = tokens[i]
    if has_digit(token):
        return True
    head, _, value = token.strip("\"'.,;:()").rpartition("=")
    value = value.strip("\"'")
    if not any(c.isalpha() for c in value):
        return False
    return _secret_cue(head) or any(_secret_cue(t) for t in tokens[max(0, i - REACH) : i]) or (len(value) >= 16 and bool(_KEY.fullmatch(value)))


def _closed(tokens: Sequence[str], i: int) -> np.ndarray:
    """What bars tags from a token."""
    if has_digit(tokens[i]):
        return _OPEN
    return _SECRET_ALONE if may_hold(tokens, i) else _SHUT


@dataclass
class ChainField:
    """A linear-chain conditional random field; ``emission[f, y]`` and ``transition[y, z]``."""

    index: dict[str, int] = field(default_factory=dict)
    emission: np.ndarray = field(default_factory=lambda: np.zeros((0, len(TAGS))))
    transition: np.ndarray = field(default_factory=lambda: np.zeros((len(TAGS), len(TAGS))))

    def scores(self, sequences: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray]:
        """``(sequences, longest, tags)`` emission scores, and lengths; tags other than O need a token that may hold them."""
        lengths = np.array([len(s) for s in sequences])
        out = np.zeros((len(sequences), int(lengths.max(initial=0)), len(TAGS)))
        for k, tokens in enumerate(sequences):
            for i in range(len(tokens)):
                known = [self.index[f] for f in token_features(tokens, i) if f in self.index]
                if known:
                    out[k, i] = self.emission[known].sum(axis=0)
                out[k, i] += _closed(tokens, i)
        return out, lengths

    def decode(self, sequences: Sequence[Sequence[str]], batch: int = 256) -> list[np.ndarray]:
        """The best tags of each sequence, by Viterbi over batches of sequences of like length."""
        out: list[np.ndarray] = [np.zeros(0, int)] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
        moves = self.transition + FORBIDDEN
        at = 0
        while at < len(order):
            most = batch if len(sequences[order[min(at + batch, len(order)) - 1]]) <= 512 else 1
            chosen = order[at : at + most]
            at += most
            score, lengths = self.scores([sequences[k] for k in chosen])
            longest = score.shape[1]
            best = score[:, 0] + START if longest else None
            back = np.zeros((len(chosen), longest, len(TAGS)), np.int8)
            for t in range(1, longest):
                each = best[:, :, None] + moves
                back[:, t] = each.argmax(axis=1)
                best = np.where((t < lengths)[:, None], each.max(axis=1) + score[:, t], best)
                back[t >= lengths, t] = np.arange(len(TAGS))
            if longest:
                path = np.zeros((len(chosen), longest), int)
                path[:, -1] = best.argmax(axis=1)
                for t in range(longest - 1, 0, -1):
                    path[:, t - 1] = back[np.arange(len(chosen)), t, path[:, t]]
                for row, k in enumerate(chosen):
                    out[k] = path[row, : lengths[row]]
        return out


#: I- follows B- or I- of its kind alone.
FORBIDDEN = np.array([[-1e4 if z[0] == "I" and y[1:] != z[1:] else 0.0 for z in TAGS] for y in TAGS])
#: Any tag; no tag or a secret; no tag.
_OPEN = np.zeros(len(TAGS))
_SECRET_ALONE = np.array([0.0 if t in ("O", "B-secret") else -1e4 for t in TAGS])
_SHUT = np.array([0.0 if t == "O" else -1e4 for t in TAGS])
START = np.array([-1e4 if t[0] == "I" else 0.0 for t in TAGS])


def train(rows: Iterable[tuple[Sequence[str], Sequence[str]]], *, steps: int = 80, rate: float = 0.2, penalty: float = 0.05) -> ChainField:
    """Fit the field to ``(tokens, tags)`` rows by gradient steps (Adam) on the penalised log-likelihood."""
    rows = [(list(a), list(b)) for a, b in rows if len(a)]
    model = ChainField()
    cells: list[tuple[int, int, int]] = []  # sequence, position, feature
    for k, (tokens, _) in enumerate(rows):
        for i in range(len(tokens)):
            cells += [(k, i, model.index.setdefault(f, len(model.index))) for f in token_features(tokens, i)]
    n, longest, size = len(rows), max((len(a) for a, _ in rows), default=0), len(TAGS)
    model.emission = np.zeros((len(model.index), size))
    if not rows:
        return model
    seq, pos, feat = np.array(cells).T
    lengths = np.array([len(a) for a, _ in rows])
    gold = np.zeros((n, longest), int)
    closed = np.zeros((n, longest, size))
    for k, (tokens, tags) in enumerate(rows):
        gold[k, : len(tags)] = [_TAG[t] for t in tags]
        for i in range(len(tokens)):
            closed[k, i] = _closed(tokens, i)
    inside = np.arange(longest) < lengths[:, None]
    wanted = (np.eye(size)[gold]) * inside[:, :, None]
    moved = np.zeros((size, size))
    for t in range(1, longest):
        np.add.at(moved, (gold[inside[:, t], t - 1], gold[inside[:, t], t]), 1)

    def logsum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)

    first = [np.zeros_like(model.emission), np.zeros_like(model.transition)]
    second = [np.zeros_like(model.emission), np.zeros_like(model.transition)]
    for step in range(1, steps + 1):
        score = closed.copy()
        np.add.at(score, (seq, pos), model.emission[feat])
        moves = model.transition + FORBIDDEN
        alpha, beta = np.zeros_like(score), np.zeros_like(score)
        alpha[:, 0] = score[:, 0] + START
        for t in range(1, longest):
            new = logsum(alpha[:, t - 1, :, None] + moves, 1) + score[:, t]
            alpha[:, t] = np.where(inside[:, t, None], new, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = logsum(moves + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(inside[:, t + 1, None], new, 0)
        total = logsum(alpha[:, -1], 1)
        expected = np.exp(alpha + beta - total[:, None, None]) * inside[:, :, None]
        pairs = np.zeros((size, size))
        for t in range(1, longest):
            p = np.exp(alpha[:, t - 1, :, None] + moves + (score[:, t] + beta[:, t])[:, None, :] - total[:, None, None])
            pairs += p[inside[:, t]].sum(axis=0)
        gap = wanted - expected
        slope = np.zeros_like(model.emission)
        np.add.at(slope, feat, gap[seq, pos])
        for j, (weights, g) in enumerate(((model.emission, slope), (model.transition, moved - pairs))):
            g = g - penalty * weights
            first[j] = 0.9 * first[j] + 0.1 * g
            second[j] = 0.999 * second[j] + 0.001 * g * g
            weights += rate * (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.999**step)) + 1e-8)
    return model


def example_rows(n: int = 300, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """The small labelled table: invented sentences with marked data and with harmless numbers."""
    rng = random.Random(seed)
    some = rng.choice

    def word() -> str:
        w = "".join(some("bcdfghklmnprst") + some("aeiouéäñ") for _ in range(rng.randint(1, 4)))
        return w + some(("", "", "", "", ",", "."))

    digits = lambda k: "".join(some("0123456789") for _ in range(k))
    hexes = lambda k: "".join(some("0123456789abcdef") for _ in range(k - 2)) + some("abcdef") + digits(1)
    capitals = lambda k: "".join(some("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(k - 1)) + digits(1)

    plain = lambda k: "".join(some("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    mixed = lambda k: "".join(some("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(k))
    upper = lambda k: "".join(some("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(k))

    def secret() -> tuple[list[str], list[str]]:
        kind = rng.randint(0, 4)
        if rng.random() < 0.4:
            return lettered()
        cue = some(("password", "passwd", "pwd", "secret", "api_key", "token", "key", "auth"))
        value = some((hexes(rng.choice((16, 18, 20, 32, 40, 64))), capitals(20), hexes(18)))
        if kind == 0:
            return [f"{cue}={value}"], ["B-secret"]
        if kind == 1:
            return [cue, "=", f'"{value}"'], ["O", "O", "B-secret"]
        if kind == 2:
            return [f"{cue}:", value], ["O", "B-secret"]
        if kind == 3:
            return ["AKIA" + capitals(16)], ["B-secret"]
        return [cue, "=", value], ["O", "O", "B-secret"]

    def lettered() -> tuple[list[str], list[str]]:
        """Secrets without a digit."""
        cue = some(("password", "Password", "passwd", "pwd", "secret", "api_key", "token", "key", "auth"))
        value = some((plain, mixed))(rng.randint(12, 32))
        return some(
            (
                lambda: ([f"{cue}={value}"], ["B-secret"]),
                lambda: ([f"{cue}:", value], ["O", "B-secret"]),
                lambda: ([f"{cue}:", value], ["O", "B-secret"]),
                lambda: ([cue, some("=:"), some((value, f'"{value}"'))], ["O", "O", "B-secret"]),
                lambda: (["AKIA" + upper(16)], ["B-secret"]),
                lambda: ([mixed(rng.randint(32, 40))], ["B-secret"]),
            )
        )()

    def marked() -> tuple[list[str], list[str]]:
        kind = rng.randint(0, 5)
        if kind <= 2:
            return secret()
        if kind == 3:
            cue = [some(("phone", "tel", "call", "mobile", "Tel.", "phone:"))]
            if rng.random() < 0.5:
                return [*cue, f"({digits(3)})", f"{digits(3)}-{digits(4)}"], ["O", "B-phone", "I-phone"]
            return [*cue, f"{digits(3)}-{digits(3)}-{digits(4)}"], ["O", "B-phone"]
        if kind == 4:
            return [some(("SSN", "ssn:", "SSN:")), f"{digits(3)}-{digits(2)}-{digits(4)}"], ["O", "B-ssn"]
        return [some(("IBAN", "iban:", "account")), some(("DE", "FR", "ES", "GB")) + digits(rng.randint(16, 24))], ["O", "B-iban"]

    def harmless() -> list[str]:
        kind = rng.randint(0, 15)
        cue = some(("token", "Token", "key", "password", "Password", "secret", "auth", "pwd"))
        return [
            lambda: ["Version", f"{digits(1)}.{digits(1)}."],
            lambda: [f"{rng.randint(1900, 2035)}"],
            lambda: [f"{digits(rng.randint(1, 5))}{some(('', '.', ',', '%', 'km', 'th'))}"],
            lambda: [f"{digits(2)}:{digits(2)}"],
            lambda: [f"{rng.randint(1900, 2035)}-{digits(2)}-{digits(2)}"],
            lambda: [f"{digits(1)}.{digits(3)},{digits(2)}"],
            lambda: ["+1", f"({digits(3)})", f"{digits(3)}-{digits(4)}"],
            lambda: [some("45") + digits(15)],
            lambda: [".".join(str(rng.randint(0, 255)) for _ in range(4))],
            lambda: [f"{word().strip('.,')}.{digits(2)}@mail{digits(1)}.example.com"],
            lambda: [f"{word().strip('.,')}{digits(rng.randint(1, 3))}"],
            lambda: [some(("token", "key", "password", "account", "call", "phone")), word(), digits(rng.randint(1, 4))],
            lambda: [cue, some(("is", "ring", "of", "for", "and", "the", word())), word(), word()],
            lambda: [f"{cue}:", plain(rng.randint(1, 8)), word()],
            lambda: [cue, plain(rng.randint(4, 16)), word()],
            lambda: [f"{cue}={some(('', 'none', 'true', 'null', 'value', plain(rng.randint(1, 7))))}"],
        ][kind]()

    rows = []
    for _ in range(n):
        tokens, tags = [], []
        for part in range(rng.randint(1, 3)):
            for _ in range(rng.randint(0, 4)):
                tokens.append(word())
                tags.append("O")
            if part == 0 and rng.random() < 0.5:
                a, b = marked()
                tail = some(("", "", ".", ","))
                tokens += [*a[:-1], a[-1] + tail]
                tags += b
            else:
                a = harmless()
                tokens += a
                tags += ["O"] * len(a)
        rows.append((tokens, tags))
    return rows


def sequences(text: str) -> Iterator[tuple[list[re.Match], int]]:
    """Runs of tokens of one line around those that may get a label, and how many of a run are context alone.

    Behind a line break the last tokens before it are context.
    """
    recent: list[re.Match] = []
    for line in _LINE.finditer(text):
        own = list(_TOKEN.finditer(text, *line.span()))
        tokens, ahead = [*recent, *own], len(recent)
        plain = [t[0] for t in tokens]
        recent = tokens[-CONTEXT:]
        cues = any(_MAYBE_CUE.search(t) for t in plain[:ahead]) or _MAYBE_CUE.search(text, *line.span())
        if not cues and not _SOME.search(text, *line.span()):
            continue
        run: list[int] = []
        for i in range(ahead, len(tokens)):
            if not may_hold(plain, i):
                continue
            if run and i - CONTEXT > run[-1] + CONTEXT:
                first = max(0, run[0] - CONTEXT)
                yield tokens[first : run[-1] + CONTEXT + 1], max(0, ahead - first)
                run = []
            run.append(i)
        if run:
            first = max(0, run[0] - CONTEXT)
            yield tokens[first : run[-1] + CONTEXT + 1], max(0, ahead - first)


def _field_span(tokens: Sequence[re.Match], kind: str) -> Span:
    """The marked tokens without quotes, stops and what stands before an equals sign."""
    start, end = tokens[0].start(), tokens[-1].end()
    text = tokens[0].string
    if kind == "secret" and (cut := text.rfind("=", start, end - 1)) >= 0:
        start = cut + 1
    while start < end - 1 and text[start] in "\"'([<":
        if kind == "phone" and text[start] == "(":
            break
        start += 1
    while end - 1 > start and text[end - 1] in "\"').,;:!?]>":
        end -= 1
    return start, end, kind


def field_spans(texts: Sequence[str], model: ChainField) -> list[list[Span]]:
    """The spans that the field finds in each text."""
    owner, runs, ahead = [], [], []
    for k, text in enumerate(texts):
        for run, context in sequences(text):
            owner.append(k)
            runs.append(run)
            ahead.append(context)
    found: list[list[Span]] = [[] for _ in texts]
    for k, run, context, path in zip(owner, runs, ahead, model.decode([[t[0] for t in r] for r in runs]), strict=True):
        i = 0
        while i < len(path):
            if path[i]:
                kind, j = TAGS[path[i]][2:], i + 1
                while j < len(path) and TAGS[path[j]] == f"I-{kind}":
                    j += 1
                if i >= context:  # the line before has its own sequences
                    found[k].append(_field_span(run[i:j], kind))
                i = j
            else:
                i += 1
    return found


def all_spans(texts: Sequence[str], model: ChainField) -> list[tuple[list[Span], list[Span]]]:
    """For each text the patterns' spans, and these with the field's spans that overlap none of them."""
    out = []
    for text, added in zip(texts, field_spans(texts, model), strict=True):
        base = pattern_spans(text)
        taken = sorted(base)
        starts, reach = [a for a, _, _ in taken], list(accumulate((b for _, b, _ in taken), max))
        free = []
        for s in added:
            before = bisect_left(starts, s[1])  # the spans that begin before this one ends
            if not before or reach[before - 1] <= s[0]:
                free.append(s)
        out.append((base, sorted([*base, *free], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))))
    return out


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def redacted(text: str, spans: Iterable[Span]) -> str:
    """Every span replaced by its kind in brackets; of overlapping spans the first to begin names the place."""
    parts, at = [], 0
    for a, b, kind in sorted(spans):
        if a >= at:
            parts += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def _candidates(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[list[int], list[str]]]:
    """Rows that may hold a span, some megabytes at a time."""
    rows = np.flatnonzero(np.asarray(pc.fill_null(pc.match_substring_regex(column, _WORTH), False)))
    held, texts, size = [], [], 0
    for i in rows:
        held.append(int(i))
        texts.append(column[int(i)].as_py())
        size += len(texts[-1])
        if size > most:
            yield held, texts
            held, texts, size = [], [], 0
    if held:
        yield held, texts


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, model: ChainField | None = None) -> DataFrame:
    """``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` for every row; the counts are the patterns'."""
    shared = df.sparkSession.sparkContext.broadcast(model or train(example_rows()))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n = batch.num_rows
            counts, digest, spans = np.zeros((4, n), np.int64), [nothing] * n, [""] * n
            for rows, texts in _candidates(batch.column(1)):
                for i, (base, every) in zip(rows, all_spans(texts, shared.value), strict=True):
                    for _, _, kind in base:
                        counts[PATTERN_KINDS.index(kind), i] += 1
                    digest[i] = hashlib.sha256(joined(base).encode()).hexdigest()
                    spans[i] = joined(every)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts), pa.array(digest, pa.string()), pa.array(spans, pa.string())], names=["id", *(f"n_{k}" for k in PATTERN_KINDS), "sha", "spans"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(search, f"id {kind}, " + ", ".join(f"n_{k} long" for k in PATTERN_KINDS) + ", sha string, spans string")
    return out.select(F.col("id").alias(id_col), *(f"n_{k}" for k in PATTERN_KINDS), F.col("sha").alias("base_sha256"), "spans")


def redact(df: DataFrame, text_col: str = "text", *, model: ChainField | None = None) -> DataFrame:
    """``df`` with every span of ``text_col`` replaced by its kind; nulls stay null."""
    shared = df.sparkSession.sparkContext.broadcast(model or train(example_rows()))

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            changed: dict[int, str] = {}
            for rows, texts in _candidates(column):
                for i, text, (_, every) in zip(rows, texts, all_spans(texts, shared.value), strict=True):
                    if every:
                        changed[i] = redacted(text, every)
            if not changed:
                yield column
                continue
            mask = np.zeros(len(column), bool)
            mask[list(changed)] = True
            yield pc.replace_with_mask(column, pa.array(mask), pa.array([changed[i] for i in sorted(changed)], column.type))

    return df.withColumn(text_col, clean(F.col(text_col)))
