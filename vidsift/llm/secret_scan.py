"""Secret scan: fixed patterns, and a linear-chain conditional random field that adds what they miss.

Tokens are runs of non-blank characters, tagged begin, inside or outside a secret from their shape, their neighbours'
words and features of the file, decoded by Viterbi. The field is trained on a bounded sample of documents, whose tags
the patterns give, and on lessons made from them: secrets of other key names and shapes set into their text, and tokens
that only look like secrets, so that it finds what the patterns do not know. A token whose score for "outside" leads by more than any change of its transitions could make good
is outside in every best path, so whole texts are decoded exactly by running Viterbi over what lies between such tokens.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, strings, sums, text_batches, tidy, words

# Fixed patterns of the base scan.
KEYS = "(password|passwd|secret|token|api_?key)"
ASSIGN = re.compile(re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", KEYS) + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "crf")
MAYBE = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"

O, B, I = 0, 1, 2


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, by start, then kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_KIND = np.zeros(256, np.uint8)  # 1 lower, 2 upper, 3 digit, 4 mark, 5 other
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 5
_KIND[_KIND == 0] = 4
_HEX = np.isin(np.arange(256), [ord(c) for c in "0123456789abcdef"])


def shapes(dictionary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of words by their own letters, and what they tell their neighbours (and the file)."""
    d = dictionary.cast(pa.large_string())
    at = np.frombuffer(d.buffers()[1], np.int64)[d.offset : d.offset + len(d) + 1]
    data = np.frombuffer(d.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    off = at - at[0]
    n = np.maximum(np.diff(off), 1)
    kind = _KIND[data]
    lower, upper, digit, mark, other = (sums(kind == i, off) for i in range(1, 6))
    turns = np.zeros(len(kind), bool)
    turns[1:] = kind[1:] != kind[:-1]
    turn = sums(turns, off) / n
    hexed = sums(_HEX[data], off) / n
    has = lambda p: pc.match_substring_regex(d, p).to_numpy(zero_copy_only=False)
    key = has("(?i:password|passwd|secret|token|api_?key)")
    eq, end = has("[:=]"), has("[:=][\"']?$")
    mixed = (digit > 0) & (lower + upper > 0)
    own = np.stack([
        np.ones(len(n)), n >= 8, n >= 12, n >= 16, n >= 24, n >= 32, digit > 0, upper > 0, mixed, mixed & (n >= 12), mixed & (n >= 18),
        (digit >= 3) & (lower + upper >= 3), (lower > 0) & (upper > 0) & (digit > 0), (upper > 0) & (lower == 0) & (digit > 0), hexed >= 0.9, (hexed >= 0.9) & (n >= 16), (hexed >= 0.9) & (digit > 1),
        mark > 0, mark / n > 0.3, other > 0, turn > 0.3, (turn > 0.3) & (n >= 12), key, key & eq, key & eq & (n >= 18), eq, end, has("^AKIA"), has("://"), has("@"), has("^[0-9+().-]+[,.]?$"),
    ], axis=1).astype(np.float64)
    near = np.stack([key, end, key & end, digit > 0, has("^[:=]$"), n >= 16], axis=1).astype(np.float64)
    return own, near


@dataclass(frozen=True)
class Field:
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    file: np.ndarray
    move: np.ndarray

    def margin(self) -> np.ndarray:
        """For begin and inside: the most that moving a token to outside can cost in transitions."""
        a = self.move
        return np.array([max(a[p, y] + a[y, n] - a[p, O] - a[O, n] for p in range(3) for n in range(3)) for y in (B, I)])


def file_features(first: np.ndarray, codes: np.ndarray, near: np.ndarray) -> np.ndarray:
    n = np.maximum(np.diff(first), 1)
    key = sums(near[codes, 0], first)
    return np.stack([key > 0, sums(near[codes, 3], first) / n > 0.05], axis=1).astype(np.float64)


def scores(field: Field, first: np.ndarray, codes: np.ndarray, own: np.ndarray, near: np.ndarray) -> np.ndarray:
    """A row of three scores for each token of a batch."""
    e = (own @ field.own)[codes]
    if len(codes) > 1:
        joined = np.ones(len(codes) - 1, bool)
        cut = first[1:-1]
        joined[cut[(cut > 0) & (cut < len(codes))] - 1] = False
        left, right = (near @ field.before)[codes[:-1]], (near @ field.after)[codes[1:]]
        e[1:] += left * joined[:, None]
        e[:-1] += right * joined[:, None]
    e += np.repeat(file_features(first, codes, near) @ field.file, np.diff(first), axis=0)
    return e


def viterbi(e: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The best tags of a run of tokens with outside on both its sides."""
    back = np.zeros((len(e), 3), np.int8)
    best = move[O] + e[0]
    for t in range(1, len(e)):
        step = best[:, None] + move
        back[t] = step.argmax(axis=0)
        best = step.max(axis=0) + e[t]
    tags = np.zeros(len(e), np.int8)
    tags[-1] = (best + move[:, O]).argmax()
    for t in range(len(e) - 1, 0, -1):
        tags[t - 1] = back[t, tags[t]]
    return tags


def tag(field: Field, first: np.ndarray, codes: np.ndarray, own: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Tags of all tokens of a batch."""
    e = scores(field, first, codes, own, near)
    m = field.margin()
    open_t = ((e[:, O] - e[:, B] <= m[0]) | (e[:, O] - e[:, I] <= m[1])).astype(np.int8)
    tags = np.zeros(len(codes), np.int8)
    at = np.flatnonzero(open_t)
    if len(at):
        doc = np.searchsorted(first, at, side="right")
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(doc) > 0)) + 1
        for run in np.split(at, cut):
            tags[run] = viterbi(e[run[0] : run[-1] + 1], field.move)
    return tags


def gold(text: str) -> list[int]:
    """Tags that the patterns give a text's tokens."""
    spans = base_spans(text)
    tags, last = [], None
    for m in re.finditer(WORD, text):
        hit = next((s for s in spans if s[1] < m.end() and m.start() < s[2]), None)
        tags.append(O if hit is None else I if hit == last else B)
        last = hit
    return tags


NAMES = ("access_key", "auth", "authorization", "bearer", "client_key", "cookie", "credential", "key", "license", "login", "passphrase", "pass", "private_key", "pwd", "session", "signature", "webhook")
JOINTS = ("=", ":", " = ", ": ", " ", " is ", " := ", '="', ": '", " -> ")
LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"


def made_secret(rng: random.Random) -> str:
    """A token of one of several shapes that secrets have."""
    draw = lambda pool, a, b: "".join(rng.choices(pool, k=rng.randint(a, b)))
    every = LETTERS + LETTERS.upper() + DIGITS
    prefix = draw(LETTERS, 2, 4) + rng.choice("_-.") + (draw(LETTERS, 3, 4) + "_" if rng.random() < 0.3 else "")
    shape = rng.randrange(7)
    if shape == 0:
        return draw(every, 20, 44)
    if shape == 1:
        return prefix + draw(every, 16, 40)
    if shape == 2:
        return draw(every + "+/", 24, 60) + "=" * rng.randrange(3)
    if shape == 3:
        return draw(DIGITS + "ABCDEF", 20, 48)
    if shape == 4:
        return "-".join(draw(DIGITS + "abcdef", n, n) for n in (8, 4, 4, 4, 12))
    if shape == 5:
        return draw(LETTERS + DIGITS, 18, 40)
    return draw(LETTERS.upper() + DIGITS, 16, 32)


def made_decoy(rng: random.Random, plain: list[str]) -> str:
    """Tokens that look like a secret or its key and are none; ``plain`` are words of real text."""
    w = lambda: re.sub("[^A-Za-z]", "", rng.choice(plain)) or "word"
    n = lambda: str(rng.randrange(10 ** rng.randint(1, 9)))
    return rng.choice([
        lambda: rng.choice(NAMES) + rng.choice(JOINTS) + w(), lambda: rng.choice(("password", "token", "secret", "api key")) + rng.choice((" ", ": ", " is ")) + w(), lambda: f"{w()}.{w()}{n()}@{w()}.com",
        lambda: f"https://{w()}.org/{w()}/{n()}?{w()}={n()}", n, lambda: f"20{rng.randint(10, 29)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}T10:{rng.randint(10, 59)}:12Z", lambda: w() + w().title() + w().title() + w().title(),
        lambda: "_".join((w(), w(), w(), w())), lambda: f"+{n()}-{n()}-{n()}", lambda: w() + w() + w() + w(), lambda: f"{w()}{n()[:3]}", lambda: f"v{n()[:1]}.{n()[:2]}.{n()[:2]}-{w()}", lambda: f"/{w()}/{w()}/{w()}_{n()[:4]}.{w()[:3]}",
    ])()


def lessons(texts: list[str], most: int, seed: int) -> tuple[list[str], list[int]]:
    """Texts and the tags of all their tokens: the given ones by the patterns, then ``most`` made from their words."""
    rng = random.Random(seed)
    out, tags = list(texts), [t for x in texts for t in gold(x)]
    found = [re.findall(WORD, t) for t in texts]
    found = [f for f in found if len(f) >= 8]
    plain = [w for f in found[:400] for w in f[:200]] or ["word"]
    for _ in range(most if found else 0):
        f = rng.choice(found)
        at = rng.randrange(len(f))
        body = [(w, t) for w, t in zip(f[at : at + 40], gold(" ".join(f[at : at + 40])), strict=True)]
        for _ in range(2):
            if rng.random() < 0.6:
                value = made_secret(rng)
                lead = rng.choice(NAMES) + rng.choice(JOINTS) if rng.random() < 0.8 else ""
                piece = [(w, B if value in w else O) for w in re.findall(WORD, (rng.choice((str.lower, str.upper, str.title))(lead) + value))]
            else:
                piece = [(w, O) for w in re.findall(WORD, made_decoy(rng, plain))]
            cut = rng.randrange(len(body) + 1)
            body[cut:cut] = piece
        out.append(" ".join(w for w, _ in body))
        tags += [t for _, t in body]
    return out, tags


def fit(texts: list[str], width: int = 16, most: int = 4000, rounds: int = 110, l2: float = 1e-3, seed: int = 5) -> Field:
    """Train on windows of ``width`` tokens of texts and lessons: those around secrets and as many drawn elsewhere,
    ``most`` at most."""
    taught, known = lessons(texts, most // 2, seed)
    first, codes, dictionary = words(pa.array(taught, pa.large_string()))
    own, near = shapes(dictionary)
    file = np.repeat(file_features(first, codes, near), np.diff(first), axis=0)
    y = np.array(known, np.int64)
    texts = taught
    rng = np.random.default_rng(seed)
    doc_of = np.repeat(np.arange(len(texts)), np.diff(first))
    hits = np.flatnonzero(y == B)
    pick = np.concatenate([rng.permutation(hits)[: most // 2], rng.integers(0, max(len(y), 1), min(most // 2, len(y)))])
    starts = np.maximum(first[doc_of[pick]], pick - rng.integers(2, width - 3, len(pick))) if len(y) else np.zeros(0, np.int64)
    idx = starts[:, None] + np.arange(width)
    end = first[doc_of[np.minimum(starts, max(len(y) - 1, 0))] + 1] if len(y) else np.zeros(0, np.int64)
    live = idx < end[:, None]
    idx = np.where(live, idx, 0)
    begin, finish = first[doc_of[starts]] if len(y) else end, end
    pads = np.zeros(near.shape[1])
    x_near = lambda shift: np.where(((idx + shift >= begin[:, None]) & (idx + shift < finish[:, None]) & live)[..., None], near[codes[np.clip(idx + shift, 0, len(codes) - 1)]], pads)
    k = own.shape[1], near.shape[1], near.shape[1], 2
    if not len(y) or not len(hits):
        z = [np.zeros((d, 3)) for d in k]
        z[0][0] = [5, -5, -5]
        return Field(*z, np.zeros((3, 3)))
    x = np.concatenate([own[codes[idx]], x_near(-1), x_near(1), file[idx]], axis=2) * live[..., None]
    tags = np.where(live, y[idx], O)
    hot = np.eye(3)[tags]
    w, a = np.zeros((x.shape[2], 3)), np.zeros((3, 3))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(a), np.zeros_like(a)]
    n = len(x)
    flat = x.reshape(-1, x.shape[2])
    for r in range(1, rounds + 1):
        e = (flat @ w).reshape(n, width, 3)
        lse = lambda z, ax: (m := z.max(axis=ax, keepdims=True)).squeeze(ax) + np.log(np.exp(z - m).sum(axis=ax))
        f, b = np.zeros_like(e), np.zeros_like(e)
        f[:, 0] = e[:, 0] + a[O]
        for t in range(1, width):
            f[:, t] = lse(f[:, t - 1, :, None] + a, 1) + e[:, t]
        b[:, -1] = a[:, O]
        for t in range(width - 2, -1, -1):
            b[:, t] = lse(a + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2)
        z = lse(f[:, -1] + a[:, O], 1)
        p = np.exp(f + b - z[:, None, None])
        pair = np.exp(f[:, :-1, :, None] + a + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]).sum(axis=(0, 1))
        gw = flat.T @ (hot - p).reshape(-1, 3) / n - l2 * w
        seen = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:])
        ends = np.outer(np.eye(3)[O], (hot[:, 0] - p[:, 0]).sum(axis=0)) + np.outer((hot[:, -1] - p[:, -1]).sum(axis=0), np.eye(3)[O])
        ga = (seen - pair + ends) / n - l2 * 5 * a
        for v, g, i in ((w, gw, 0), (a, ga, 2)):
            state[i] = 0.9 * state[i] + 0.1 * g
            state[i + 1] = 0.999 * state[i + 1] + 0.001 * g * g
            v += 0.1 * (state[i] / (1 - 0.9**r)) / (np.sqrt(state[i + 1] / (1 - 0.999**r)) + 1e-8)
    cut = np.cumsum(k)
    return Field(w[: cut[0]], w[cut[0] : cut[1]], w[cut[1] : cut[2]], w[cut[2] :], a)


def train(docs: DataFrame, text: str = "text", max_docs: int = 2000, max_chars: int = 20_000) -> Field:
    """Fit on at most ``max_docs`` different texts, the first by a hash: half that may hold a match, half any.

    Of a text longer than ``max_chars`` a stretch of that length is taken, about its first match or at a place that the
    hash draws. One pass counts, one brings the sample; equal texts count once.
    """
    h, n = F.xxhash64("t"), F.length("t")
    d = docs.select(F.col(text).alias("t")).where(n > 0)
    may = F.regexp_instr("t", F.lit("(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]|AKIA[A-Z0-9]{14}"))
    start = F.greatest(F.lit(1), F.when(F.col("may") > 0, F.col("may") - max_chars // 2).otherwise(1 + F.pmod("h", F.greatest(F.lit(1), n - max_chars)))).cast("int")
    d = d.select("t", h.alias("h"), may.alias("may"))
    every, hits = d.agg(F.approx_count_distinct("h", 0.02), F.approx_count_distinct(F.when(F.col("may") > 0, F.col("h")), 0.02)).first()
    below = lambda total: F.col("h") <= min(2**63 - 1, int(-(2**63) + 1.1 * (max_docs // 2 + 50) / max(1, total) * 2**64))
    some = d.where(below(every) | ((F.col("may") > 0) & below(hits))).select("h", (F.col("may") > 0).alias("hit"), F.substring("t", start, F.lit(max_chars)).alias("t"))
    got = sorted(map(tuple, some.dropDuplicates(["h"]).limit(4 * max_docs).collect()))
    half = max_docs // 2
    return fit(sorted({t for _, _, t in [r for r in got if r[1]][:half] + got[:half]}))


def clear_of(extra: list[tuple], held: list[tuple]) -> list[tuple]:
    """Spans of ``extra`` that overlap none of ``held``; both by start."""
    ends = list(itertools.accumulate((s[2] for s in held), max))
    starts = [s[1] for s in held]
    return [x for x in extra if not (at := bisect.bisect_left(starts, x[2])) or ends[at - 1] <= x[1]]


def scan(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive; the field's spans have kind crf and overlap no base span.
    Null and empty texts have none; repeated rows each get a row; other columns are ignored.
    """

    def rows(batches):
        for b in text_batches(batches, 4_000_000):
            t = strings(b.column("text"))
            maybe = pc.match_substring_regex(t, MAYBE).to_numpy(zero_copy_only=False)
            first, codes, dictionary = words(t)
            own, near = shapes(dictionary)
            tags = tag(field, first, codes, own, near)
            marked = np.unique(np.searchsorted(first, np.flatnonzero(tags), side="right") - 1)
            base: dict[int, list] = {}
            spans: dict[int, list] = {}
            for i in np.flatnonzero(maybe).tolist():
                base[i] = spans[i] = base_spans(t[i].as_py())
            for i in marked.tolist():
                own_tags = tags[first[i] : first[i + 1]]
                at = list(re.finditer(WORD, t[i].as_py()))
                extra = []
                for j in np.flatnonzero(own_tags).tolist():
                    if own_tags[j] == I and extra and extra[-1][3] == j - 1:
                        extra[-1] = ("crf", extra[-1][1], at[j].end(), j)
                    else:
                        extra.append(("crf", at[j].start(), at[j].end(), j))
                held = base.get(i, [])
                extra = clear_of([x[:3] for x in extra], held)
                spans[i] = sorted(held + extra, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
            n = b.num_rows
            count = lambda kind: pa.array([sum(s[0] == kind for s in base.get(i, ())) for i in range(n)], pa.int64())  # noqa: B023, E731
            none = hashlib.sha256(b"").hexdigest()
            sha = [hashlib.sha256(listed(base[i]).encode()).hexdigest() if i in base else none for i in range(n)]
            yield pa.record_batch([b.column("doc_id"), count("assign"), count("access"), count("hex"), pa.array(sha), pa.array([listed(spans.get(i, [])) for i in range(n)], pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(tidy(rows), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
