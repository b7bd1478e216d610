"""Toxicity: a learned lexicon, searched with misspellings allowed, and a score of the context of what is found.

The lexicon holds words and word stems that labelled toxic documents use and others do not. Its trie is intersected with
the Levenshtein automaton of each entry: a state is the set of (trie node, edits so far) that the letters read can have
led to, and the deterministic automaton over those sets is built as far as words of the corpus ask for it. What is found
counts by its strength, its edits and its context: a term inside quotation marks or beside a word of reporting is
quotation rather than abuse. A logistic model of the evidence in the whole text and in its worst window gives the score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import Scratch, bounded_sample, strings, text_batches, tidy, words

# Marks at the edge of a word, quotation marks, words of reporting.
EDGES = ".,;:!?()[]{}<>*_~\"'“”„«»‘’‹›…"
OPENING = ('"', "“", "„", "«", "‹", "‘", "'")
CLOSING = ('"', "”", "“", "»", "›", "’", "'")
REPORTING = frozenset(
    "said says saying called calls calling quote quoted quotes word words term terms slur insult insults phrase wrote writes reported means meaning "
    "sagte nannte wort begriff zitat beleidigung dit appelé mot terme insulte citation dijo llamó palabra término insulto cita".split()
)
WINDOW = 12
STEMS = range(3, 9)  # lengths of the beginnings of words that may become stems
DAMP = 0.7  # an edit leaves so much of a term's strength
CROWDED = 3  # so many ordinary words near a term forbid its misspellings
QUOTED = 0.15  # quotation leaves so much of it


def edits_allowed(term: str) -> int:
    """Misspellings: none in words under five letters, one under eight, two in longer ones."""
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Speller:
    """Finds the lexicon entry that a word is, begins with (stems), or misspells."""

    def __init__(self, terms: list[str], known: frozenset[str] = frozenset(), exact: frozenset[str] = frozenset(), most_states: int = 100_000):
        """``known`` words are no misspellings, and ``exact`` terms have none. A stem is an entry too: words that begin
        with it, unchanged, are it."""
        self.terms, self.known, self.most_states = terms, known, most_states
        self.allowed = [0 if t in exact else edits_allowed(t) for t in terms]
        self.children: list[dict[str, int]] = [{}]
        self.entry = [-1]
        for i, term in enumerate(terms):
            at = 0
            for ch in term:
                if ch not in self.children[at]:
                    self.children[at][ch] = len(self.children)
                    self.children.append({})
                    self.entry.append(-1)
                at = self.children[at][ch]
            self.entry[at] = i
        self.most = [0] * len(self.children)  # edits that an entry below may still have
        for at in range(len(self.children) - 1, -1, -1):
            own = self.allowed[self.entry[at]] if self.entry[at] >= 0 else 0
            self.most[at] = max([own, *(self.most[c] for c in self.children[at].values())])
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[frozenset, int] = {frozenset(): 0}
        self.sets: list[frozenset] = [frozenset()]
        self.steps: list[dict[str, int]] = [{}]
        self.ends: list[tuple[int, int] | None] = [None]
        self.stems: list[int] = [-1]
        self.begin = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """The number of a state, given the fewest edits for each trie node; skipping letters of an entry is free to try."""
        todo = list(reached.items())
        while todo:
            at, e = todo.pop()
            for child in self.children[at].values():
                if e < self.most[child] and reached.get(child, 99) > e + 1:
                    reached[child] = e + 1
                    todo.append((child, e + 1))
        key = frozenset(reached.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            hits = [(e, self.entry[at]) for at, e in key if self.entry[at] >= 0 and e <= self.allowed[self.entry[at]]]
            self.ends.append(min(hits)[::-1] if hits else None)
            self.stems.append(next((i for e, i in hits if e == 0), -1))
        return self.ids[key]

    def _step(self, state: int, ch: str) -> int:
        reached: dict[int, int] = {}
        for at, e in self.sets[state]:
            if e < self.most[at] and reached.get(at, 99) > e + 1:
                reached[at] = e + 1
            for c, child in self.children[at].items():
                cost = e + (c != ch)
                if (c == ch or cost <= self.most[child]) and reached.get(child, 99) > cost:
                    reached[child] = cost
        to = self._state(reached) if reached else 0
        self.steps[state][ch] = to
        return to

    def find(self, word: str) -> tuple[int, int] | None:
        """(entry, edits): a stem that the word begins with, else the entry that is the fewest edits away, if near enough."""
        if len(self.sets) > self.most_states:
            self._clear()
        state, stem = self.begin, -1
        for ch in word:
            to = self.steps[state].get(ch)
            state = self._step(state, ch) if to is None else to
            if not state:
                break
            if self.stems[state] >= 0:
                stem = self.stems[state]
        if stem >= 0:
            return stem, 0
        found = self.ends[state]
        return None if found is None or word in self.known else found


@dataclass(frozen=True)
class Hit:
    at: int
    entry: int
    edits: int
    quoted: bool


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    strength: list[float] = field(default_factory=list)
    known: frozenset[str] = frozenset()
    exact: frozenset[str] = frozenset()
    weights: tuple[float, ...] = (-4.0, 8.0, 0.0, 0.0)
    _speller: Speller | None = field(default=None, repr=False, compare=False)

    @property
    def speller(self) -> Speller:
        if self._speller is None:
            self._speller = Speller(self.terms, self.known, self.exact)
        return self._speller

    def __getstate__(self):
        return self.__dict__ | {"_speller": None}


def bare(kinds: pa.Array) -> list[str]:
    """Words in lower case, without marks at their edges."""
    return pc.utf8_trim(pc.utf8_lower(kinds), characters=EDGES).to_pylist()


def _quoted(at: int, raw: list[str], plain: list[str]) -> bool:
    """``raw`` and ``plain`` are the words of the window, ``at`` the term's place: inside quotation marks, or reported."""
    opens = any(w.startswith(OPENING) for w in raw[: at + 1])
    closes = any(w.rstrip(".,;:!?").endswith(CLOSING) for w in raw[at:])
    near = plain[max(0, at - 4) : at] + plain[at + 1 : at + 4]
    return (opens and closes) or any(w in REPORTING for w in near)


def find_hits(texts: pa.Array, model: Model) -> tuple[list[list[Hit]], np.ndarray]:
    """Of each text what the lexicon finds, by place, and its number of words."""
    first, codes, kinds = words(texts)
    plain, raw = bare(kinds), None
    speller = model.speller
    found = {i: hit for i, w in enumerate(plain) if w and (hit := speller.find(w))}
    out: list[list[Hit]] = [[] for _ in range(len(first) - 1)]
    if found:
        raw = kinds.to_pylist()
        hot = np.zeros(len(plain), bool)
        hot[list(found)] = True
        for at in np.flatnonzero(hot[codes]).tolist():
            d = int(np.searchsorted(first, at, "right")) - 1
            lo, hi = max(int(first[d]), at - WINDOW), min(int(first[d + 1]), at + WINDOW + 1)
            near = codes[lo:hi].tolist()
            entry, edits = found[int(codes[at])]
            out[d].append(Hit(at - int(first[d]), entry, edits, _quoted(at - lo, [raw[c] for c in near], [plain[c] for c in near])))
    return out, np.diff(first)


def evidence(hits: list[Hit], n_words: int, strength: list[float]) -> tuple[float, ...]:
    """(1, evidence of the whole text, of its worst window, of quotations), the latter three from 0 to 1."""
    open_, quoted = [], 0.0
    for h in hits:
        s = strength[h.entry] * DAMP**h.edits
        quoted += s * h.quoted
        open_.append((h.at, s * (QUOTED if h.quoted else 1.0)))
    total = sum(s for _, s in open_)
    worst = held = 0.0
    left = 0
    for at, s in open_:
        held += s
        while open_[left][0] < at - WINDOW:
            held -= open_[left][1]
            left += 1
        worst = max(worst, held)
    soft = lambda x: x / (x + 8.0)
    return (1.0, soft(total), soft(worst), soft(quoted))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, ...]:
    """Weights of a logistic model by Newton's steps; a prior keeps quotations from counting without examples."""
    prior, tight = np.array([-3.0, 6.0, 1.0, 0.0]), np.array([0.01, 0.02, 0.2, 0.2])
    w = prior.copy()
    if not len(y):
        return tuple(w.tolist())
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        g = x.T @ (y - p) - tight * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(tight), g)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def _chance(a, b, toxic: int, clean: int) -> tuple[float, float]:
    """(log odds of a term that a toxic and b clean documents hold, chance bound of so uneven a split)."""
    n, share = a + b, toxic / (toxic + clean)
    g = a * math.log(a / (n * share)) + (b * math.log(b / (n * (1 - share))) if b else 0.0)
    return math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1)), math.exp(-g)


def choose(counts: list[tuple[str, int, int]], toxic: int, clean: int, tested: dict[int, int]) -> tuple[list[str], list[float]]:
    """Terms and strengths of the lexicon, from (term, toxic, clean) documents.

    A term needs 20 times the share in toxic documents, nine of ten of its documents toxic, and a split that chance would
    give to fewer than half a term among those held by as many documents (``tested``). Of beginnings of one word the
    shortest that qualifies counts, lengthened as long as it keeps 95 % of its documents.
    """
    good = {}
    for term, a, b in counts:
        if a < 2 or a < 9 * b:
            continue
        odds, chance = _chance(a, b, toxic, clean)
        if odds >= 3 and chance * tested.get(a + b, 1) <= 0.5:
            good[term] = (a, min(odds, 8.0))
    kept: dict[str, float] = {}
    for term in sorted(good, key=lambda t: (len(t), t)):
        if any(term[:i] in kept for i in range(1, len(term) + 1)):
            continue
        best = term
        longer = sorted((t for t in good if t.startswith(term) and good[t][0] >= 0.95 * good[term][0]), key=lambda t: (-len(t), t))
        if longer:
            best = longer[0]
        kept[best] = good[best][1]
    terms = sorted(kept)
    return terms, [kept[t] for t in terms]


def _sketches(texts: pa.Array) -> np.ndarray:
    """Two least hashes of the pairs of neighbouring words of each text: copies with small edits mostly share them."""
    first, codes, kinds = words(texts)
    h = np.array([hash_ & 0xFFFFFFFF for hash_ in (_crc(w) for w in kinds.to_pylist())], np.uint64)
    out = np.zeros((len(first) - 1, 2), np.int64)
    for d in range(len(out)):
        x = h[codes[first[d] : first[d + 1]]]
        if len(x):
            pair = x * np.uint64(0x9E3779B97F4A7C15) + np.roll(x, -1)
            for k, odd in enumerate((0xBF58476D1CE4E5B9, 0x94D049BB133111EB)):
                mixed = (pair ^ (pair >> np.uint64(29))) * np.uint64(odd)
                out[d, k] = int((mixed >> np.uint64(1)).min())
    return out


def _crc(word: str) -> int:
    import zlib

    return zlib.crc32(word.encode())


def _term_counts(texts: pa.Array, y: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(terms, toxic documents, clean documents) of a batch: whole words and their beginnings, once a document."""
    first, codes, kinds = words(texts)
    number: dict[str, int] = {}
    held = []
    for w in bare(kinds):
        mine = {w[:n] for n in STEMS if len(w) >= n} | ({w} if len(w) >= STEMS.start else set())
        held.append([number.setdefault(t, len(number)) for t in mine if t.isalpha()])
    sizes = np.array([len(x) for x in held], np.int64)
    flat = np.array([t for x in held for t in x], np.int64)
    starts = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(y)), np.diff(first))
    n = sizes[codes]
    at = np.repeat(starts[codes] - np.cumsum(n) + n, n) + np.arange(n.sum())
    pairs = np.unique(np.repeat(doc, n) * max(1, len(number)) + flat[at]) if len(at) else np.empty(0, np.int64)
    terms, docs = pairs % max(1, len(number)), pairs // max(1, len(number))
    count = lambda k: np.bincount(terms[y[docs] == k], minlength=len(number))
    return list(number), count(1), count(0)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", max_rows: int = 20_000, max_terms: int = 5_000, max_known: int = 20_000) -> Model:
    """Learn lexicon and weights from at most ``max_rows`` labelled documents, the first by a hash of their id.

    Labels other than 0 and 1 and null ids are left out; of several labels of a document the greatest counts; of rows
    that share an id one text counts. Of texts that are copies of each other but for small edits one counts for the
    lexicon, so that the random words of a much copied text do not become terms. What comes to the driver is bounded by
    the three parameters. Without toxic or clean documents the lexicon is empty.
    """
    spark = docs.sparkSession
    ids = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("id")).agg(F.max(label).cast("long").alias("y"))
    chosen = bounded_sample(ids, max_rows)
    plain = StructType([StructField("id", LongType()), StructField("y", LongType())])
    small = F.broadcast(spark.createDataFrame([(int(r.id), int(r.y)) for r in chosen], plain))
    given = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(small, "id")
    scratch = Scratch(spark)
    sample = scratch.save(given.groupBy("id", "y").agg(F.min("text").alias("text")), "labelled")

    def sketched(batches):
        for b in text_batches(batches):
            s = _sketches(strings(b.column("text")))
            yield pa.record_batch([b.column("id"), b.column("y"), pa.array(s[:, 0]), pa.array(s[:, 1])], names=["id", "y", "s1", "s2"])

    rows = sorted(map(tuple, sample.mapInArrow(tidy(sketched), "id long, y long, s1 long, s2 long").collect()))
    seen: set[tuple[int, int, int]] = set()
    alone = []
    for i, y, *s in rows:
        keys = {(y, k, v) for k, v in enumerate(s)}
        if not keys & seen:
            alone.append((i, y))
        seen |= keys
    toxic, clean = sum(y for _, y in alone), sum(1 - y for _, y in alone)
    if not toxic or not clean:
        scratch.drop()
        return Model()

    def counted(batches):
        for b in text_batches(batches):
            terms, a, n = _term_counts(strings(b.column("text")), b.column("y").to_numpy())
            yield pa.record_batch([pa.array(terms, pa.string()), pa.array(a), pa.array(n)], names=["term", "a", "b"])

    one_each = sample.join(F.broadcast(spark.createDataFrame([(i,) for i, _ in alone], "id long")), "id", "left_semi")
    counts = one_each.select("y", "text").mapInArrow(tidy(counted), "term string, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counts = scratch.save(counts.where("a + b > 1"), "terms")
    by_size = sorted((int(r.n), int(r["count"])) for r in counts.groupBy((F.col("a") + F.col("b")).alias("n")).count().collect())
    above = np.cumsum([c for _, c in by_size][::-1])[::-1]
    tested = {n: int(x) for (n, _), x in zip(by_size, above, strict=True)}
    likely = counts.where((F.col("a") >= 2) & (F.col("a") >= 9 * F.col("b"))).orderBy(F.desc("a"), "b", "term").limit(20 * max_terms)
    terms, strength = choose([tuple(r) for r in likely.collect()], toxic, clean, tested)
    if len(terms) > max_terms:
        best = sorted(range(len(terms)), key=lambda i: (-strength[i], terms[i]))[:max_terms]
        terms, strength = [terms[i] for i in sorted(best)], [strength[i] for i in sorted(best)]
    model = Model(terms, strength)

    def spelled(batches):
        for b in text_batches(batches):
            first, codes, kinds = words(strings(b.column("text")))
            plain_words = bare(kinds)
            fuzzy = {i: h[0] for i, w in enumerate(plain_words) if w and (h := model.speller.find(w)) and h[1]}
            hot = np.zeros(len(plain_words), bool)
            hot[list(fuzzy)] = True
            places = np.flatnonzero(hot[codes])
            doc = np.searchsorted(first, places, "right") - 1
            at = codes[places].tolist()
            yield pa.record_batch([pa.array([plain_words[c] for c in at], pa.string()), pa.array([terms[fuzzy[c]] for c in at], pa.string()), b.column("y").take(pa.array(doc))], names=["word", "term", "y"])

    # a word that clean documents use as often as toxic ones is a word of its own, no misspelling; a term with several
    # such neighbours stands where ordinary words are one or two letters apart, and is taken as written only
    used = sample.select("y", "text").mapInArrow(tidy(spelled), "word string, term string, y long").groupBy("word", "term").agg(F.sum("y").alias("a"), F.count("*").alias("n"))
    known = used.where("2 * a <= n").orderBy(F.desc("n"), "word").limit(max_known).collect()
    crowd: dict[str, int] = {}
    for r in known:
        crowd[r.term] = crowd.get(r.term, 0) + 1
    model = Model(terms, strength, frozenset(r.word for r in known), frozenset(t for t, n in crowd.items() if n >= CROWDED))

    def measured(batches):
        for b in text_batches(batches):
            hits, n = find_hits(strings(b.column("text")), model)
            x = [list(evidence(h, int(m), strength)) for h, m in zip(hits, n, strict=True)]
            yield pa.record_batch([b.column("id"), b.column("y"), pa.array(x, pa.list_(pa.float64()))], names=["id", "y", "x"])

    got = sorted(map(tuple, sample.mapInArrow(tidy(measured), "id long, y long, x array<double>").collect()))
    scratch.drop()
    return Model(terms, strength, model.known, model.exact, fit(np.array([g[2] for g in got]), np.array([g[1] for g in got])))


def _score(hits: list[Hit], n: int, model: Model) -> float:
    z = float(np.dot(evidence(hits, n, model.strength), model.weights))
    return 1 / (1 + math.exp(-min(35.0, max(-35.0, z))))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted, hits array<struct<word, term, edits, quoted>>) for each row of docs.

    ``word`` is the number of the word in the text. Null texts score as empty ones; repeated rows each give a row; other
    columns are ignored.
    """

    def rows(batches):
        for b in text_batches(batches):
            hits, n = find_hits(strings(b.column("text")), model)
            s = np.array([_score(h, int(m), model) for h, m in zip(hits, n, strict=True)], np.float64)
            flat = [h for each in hits for h in each]
            offsets = np.concatenate([[0], np.cumsum([len(h) for h in hits])])
            spans = pa.StructArray.from_arrays([pa.array([h.at for h in flat], pa.int64()), pa.array([model.terms[h.entry] for h in flat], pa.string()), pa.array([h.edits for h in flat], pa.int32()), pa.array([h.quoted for h in flat], pa.bool_())], ["word", "term", "edits", "quoted"])
            yield pa.record_batch([b.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)], names=["doc_id", "score", "predicted", "hits"])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(tidy(rows), "doc_id long, score double, predicted int, hits array<struct<word:long,term:string,edits:int,quoted:boolean>>")
