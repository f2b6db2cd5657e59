"""Toxicity: a learned lexicon, misspellings by Levenshtein automaton, quotation by context.

The lexicon is learned from labelled texts: whole words, and stems (beginnings of words) for terms
that occur with many endings. The whole words that a stem covers are kept beside it, as only whole
words are searched with edits. The lexicon is a trie. A word is looked up by walking the trie and the
Levenshtein automaton of the word side by side, so all terms within the allowed distance are found
without comparing the word with each term. A hit inside a quotation that a word of report
introduces, follows or comments within the context window counts apart from direct ones. The document's score is a logistic function of its hits.
"""

from __future__ import annotations

import heapq
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.llm.text import fold, labelled_sample, words
from voltmart.session import cut_lineage

SAMPLE = 20_000  # labelled rows to learn from, at most
STEM = (4, 5, 6, 7, 8)  # lengths of stems
CACHED_WORDS = 400_000
MOST_STATES = 200_000  # of the product that are remembered
CONTEXT = 6  # words on each side of a hit

# Words that report or mention speech, in the four languages of the data.
REPORT = frozenset(
    "said says wrote quoted quote called word term says dit écrit cité mot sagte schrieb zitat wort dijo escribió cita palabra".split()
)
# Quotation marks and the kind of each; marks of one kind open and close each other.
QUOTES = {'"': 0, "“": 1, "”": 1, "„": 1, "«": 2, "»": 2, "'": 3, "‘": 3, "’": 3}
MARK = re.compile("[\n" + "".join(QUOTES) + "]")
# A token begins and ends with a letter, digit or mark; signs inside may stand for letters.
TOKEN = re.compile(r"\w(?:[\w@$*!|]*\w)?")


@dataclass
class Node:
    """A trie node; ``word`` and ``stem`` are the term that ends here, as an index, or -1."""

    next: dict[str, Node] = field(default_factory=dict)
    word: int = -1
    stem: int = -1
    number: int = 0
    bound: int = 0  # edits that some whole term below tolerates


def allowed(term: str) -> int:
    """Edits a term tolerates by its length."""
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class Lexicon:
    """Terms in a trie, searched by the product of the trie and a Levenshtein automaton.

    The product is made deterministic as words need it: a state is a set of trie nodes with the
    edits spent to get there, and its steps are remembered. Looking a word up then costs one
    dictionary access per character, and most words leave the product after a few.
    """

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        self.root = Node()
        self.letters = {c for t, stem in terms if not stem for c in t}
        for k, (term, stem) in enumerate(terms):
            node = self.root
            for c in term:
                node = node.next.setdefault(c, Node())
            if stem:
                node.stem = k
            else:
                node.word = k
                node.bound = allowed(term)
        # A word that begins with a stem of the lexicon is of the stem's kind.
        self.kinds = [self._kind(term, k) for k, (term, _) in enumerate(terms)]
        self.nodes: list[Node] = []
        self._number(self.root)
        self.seen: dict[str, tuple[int, int] | None] = {}
        self._reset()

    def _kind(self, term: str, k: int) -> int:
        node = self.root
        for c in term:
            node = node.next[c]
            if node.stem >= 0:
                return node.stem
        return k

    def _number(self, node: Node) -> int:
        """Give the node a number, and the edits that any whole term below it tolerates."""
        node.number = len(self.nodes)
        self.nodes.append(node)
        for child in node.next.values():
            node.bound = max(node.bound, self._number(child))
        return node.bound

    def _reset(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.ends: list[tuple[int, int] | None] = []
        self.start = self._state({(0, 0, "")})

    def find(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the best match of a lower-case word; exact before stem before edits."""
        if word in self.seen:
            return self.seen[word]
        if len(self.seen) >= CACHED_WORDS:
            self.seen.clear()
        hit = self.seen[word] = self._exact(word) or self._near(word)
        return hit

    def _exact(self, word: str) -> tuple[int, int] | None:
        node, stem = self.root, -1
        for c in word:
            node = node.next.get(c)
            if node is None:
                break
            if node.stem >= 0:
                stem = node.stem
        else:
            if node.word >= 0:
                return node.word, 0
        return (stem, 0) if stem >= 0 else None

    def _near(self, word: str) -> tuple[int, int] | None:
        if len(word) < 3:
            return None
        if len(self.states) > MOST_STATES:
            self._reset()
        state = self.start
        for c in word:
            if c not in self.letters:
                c = ""  # all other characters act alike
            after = self.steps[state].get(c)
            if after is None:
                after = self.steps[state][c] = self._step(state, c)
            if after < 0:
                return None
            state = after
        return self.ends[state]

    def _state(self, places: set[tuple[int, int, str]]) -> int:
        """Number of the state with these places, those reached by missing characters added; -1 if none.

        A place is (node, edits, awaited): with ``awaited`` set, two characters were swapped and
        the first of them must come next.
        """
        stack = list(places)
        while stack:
            number, edits, awaited = stack.pop()
            if awaited:
                continue
            for child in self.nodes[number].next.values():
                more = (child.number, edits + 1, "")
                if edits < child.bound and more not in places:
                    places.add(more)
                    stack.append(more)
        if not places:
            return -1
        key = frozenset(places)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            found = [
                (edits, self.nodes[n].word) for n, edits, awaited in key
                if not awaited and self.nodes[n].word >= 0 and edits <= allowed(self.terms[self.nodes[n].word][0])
            ]
            self.ends.append((min(found)[1], min(found)[0]) if found else None)
        return self.numbers[key]

    def _step(self, state: int, c: str) -> int:
        out: set[tuple[int, int, str]] = set()
        for number, edits, awaited in self.states[state]:
            node = self.nodes[number]
            if awaited:
                if awaited == c:
                    out.add((number, edits, ""))
                continue
            if edits < node.bound:
                out.add((number, edits + 1, ""))  # c is one too many
            for x, child in node.next.items():
                if x == c:
                    out.add((child.number, edits, ""))
                elif edits < child.bound:
                    out.add((child.number, edits + 1, ""))  # c in place of x
                    far = child.next.get(c)
                    if far is not None and edits < far.bound:
                        out.add((far.number, edits + 1, x))  # x and c are swapped
        return self._state(out)


@dataclass
class Model:
    terms: list[tuple[str, bool]]
    weights: np.ndarray  # of the features, then the constant
    strange: dict[str, float]  # misspelled forms seen in training: toxic share


def quotations(text: str) -> list[tuple[int, int]]:
    """Disjoint spans inside quotation marks, in order; nested ones belong to the outer.

    A mark between two letters or digits is an apostrophe. Straight and single marks open before
    a word and close after one. A mark that its line does not close quotes nothing.
    """
    spans: list[tuple[int, int]] = []
    opened: dict[int, int] = {}
    for m in MARK.finditer(text):
        at, kind = m.start(), QUOTES.get(m[0])
        if kind is None:
            opened.clear()
            continue
        before, after = text[at - 1] if at else " ", text[at + 1] if at + 1 < len(text) else " "
        if before.isalnum() and after.isalnum():
            continue
        straight = kind in (0, 3)
        if kind in opened:
            if not straight or not (before.isspace() or after.isalnum()):
                spans.append((opened.pop(kind), at))
        elif not straight and m[0] != "”" or straight and not (before.isalnum() or after.isspace()):
            opened[kind] = at
    spans.sort()
    outer: list[tuple[int, int]] = []
    for a, b in spans:
        if outer and a < outer[-1][1]:
            outer[-1] = (outer[-1][0], max(b, outer[-1][1]))
        else:
            outer.append((a, b))
    return outer


def features(text: str, lexicon: Lexicon, strange: dict[str, float]) -> tuple[np.ndarray, set[str]]:
    """Hits of a whole text: direct, misspelled, quoted, kinds of terms, density; and the misspelled forms."""
    lower = text.lower()
    forms = set(TOKEN.findall(lower))
    known = {f: hit for f in forms if (hit := lexicon.find(f)) is not None}
    if not known:
        return np.zeros(5), set()
    direct = fuzzy = quoted = 0.0
    spans = list(TOKEN.finditer(lower))
    n, starts = len(spans), [m.start() for m in spans]
    quotes = quotations(lower)
    opens = [a for a, _ in quotes]
    kinds, odd = set(), set()
    for k, m in enumerate(spans):
        if m[0] not in known:
            continue
        term, edits = known[m[0]]
        weight = 1.0
        if edits:
            odd.add(m[0])
            weight = strange.get(m[0], 0.5)
        q = bisect_right(opens, m.start()) - 1
        if q >= 0 and m.start() < quotes[q][1]:
            # The window lies around the hit, before the quotation and after it.
            first, last = (bisect_left(starts, x) for x in quotes[q])
            near = spans[max(0, k - CONTEXT) : k + 1 + CONTEXT] + spans[max(0, first - CONTEXT) : first] + spans[last : last + CONTEXT]
            if any(x[0] in REPORT for x in near):
                quoted += weight
                continue
        if edits:
            fuzzy += weight
        else:
            direct += weight
        if weight >= 0.5:
            kinds.add(lexicon.kinds[term])
    return np.array([np.log1p(direct), np.log1p(fuzzy), np.log1p(quoted), len(kinds) ** 0.5, np.sqrt((direct + fuzzy) / max(n, 1))]), odd


def least_gain(positives: int) -> int:
    """Toxic texts, less four times the clean ones, that a term must add."""
    return max(3, positives // 200)


def choose_terms(rows: list[tuple[str, bool, int, int]], holders: dict[str, Sequence[int]], positives: int) -> list[tuple[str, bool]]:
    """Greedy cover: the term in most toxic texts not yet covered, less its clean texts, comes next.

    Copies of one toxic text are covered together, so words that are frequent only because a text
    was copied are not chosen. Ties go to whole words, then longer terms, then by name. All terms
    take part, until none adds ``least_gain``. Gains only fall, so a term whose gain is still the
    same when its turn comes is the best.
    """
    least = least_gain(positives)
    clean = {(t, s): b for t, s, _, b in rows}
    held = {k: np.array(sorted(holders.get(_key(*k), ())), np.int64) for k in clean}
    texts, places = np.unique(np.concatenate([np.zeros(0, np.int64), *held.values()]), return_inverse=True)
    held = dict(zip(held, np.split(places.astype(np.int32), np.cumsum([len(x) for x in held.values()])[:-1]))) if held else {}
    uncovered = np.ones(len(texts), bool)
    # Later in the order of (stem, length, name) wins a tie.
    rank = {k: i for i, k in enumerate(sorted(clean, key=lambda k: (not k[1], len(k[0]), k[0])))}
    queue = [(4 * clean[k] - len(held[k]), -rank[k], k) for k in clean]
    heapq.heapify(queue)
    chosen: list[tuple[str, bool]] = []
    while queue and -queue[0][0] >= least:
        before, place, k = queue[0]
        gain = int(np.count_nonzero(uncovered[held[k]])) - 4 * clean[k]
        if gain < least:
            heapq.heappop(queue)
        elif gain < -before:
            heapq.heapreplace(queue, (-gain, place, k))
        else:
            heapq.heappop(queue)
            chosen.append(k)
            uncovered[held[k]] = False
    return chosen


def stem_words(rows: list[tuple[str, bool, int, int]], chosen: list[tuple[str, bool]]) -> list[tuple[str, bool]]:
    """The whole words among the rows that a chosen stem covers and that are not chosen themselves.

    Only whole words are searched with edits, so without these the misspellings of a stem's words
    would be missed.
    """
    stems = {t for t, stem in chosen if stem}
    have = set(chosen)
    words = sorted(t for t, stem, _, _ in rows if not stem and (t, False) not in have)
    return [(t, False) for t in words if any(t[:n] in stems for n in STEM)]


def _key(term: str, stem: bool) -> str:
    return term + "*" if stem else term


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 0) -> Model | None:
    """Learn from at most SAMPLE labelled rows outside the held-out fold; None without both classes.

    The sample's texts stay distributed. Evidence for terms is counted over different texts, not
    rows. The driver gets the terms that pass the evidence test, which toxic texts of the sample
    hold those that can still be chosen, and five numbers per sampled text; SAMPLE bounds them all.
    """
    ids = labelled_sample(labels.where(fold(F.col(id_col), folds) != held), "toxic", SAMPLE)
    sample = cut_lineage(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(ids), "doc_id")
        .select("doc_id", "label", F.coalesce("text", F.lit("")).alias("text"))
    )
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if set(sizes) != {0, 1}:
        return None
    forms = sample.select(
        F.xxhash64("text").alias("row"),
        "label",
        F.explode(F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{M}]+"), lambda w: F.length(w) >= 3))).alias("w"),
    )
    stems = F.flatten(
        F.array(
            F.array("w"),
            *[F.when(F.length("w") > n, F.array(F.concat(F.substring("w", 1, n), F.lit("*")))).otherwise(F.array().cast("array<string>")) for n in STEM],
        )
    )
    terms = forms.select("row", "label", F.explode(stems).alias("term")).distinct()
    rows = (
        terms.groupBy("term")
        .agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
        .where("a >= 3 AND a >= 9 * b")
    )
    rows = cut_lineage(rows)
    listed = [(r["term"].rstrip("*"), r["term"].endswith("*"), r["a"], r["b"]) for r in rows.collect()]
    positives = sample.where("label = 1").select(F.xxhash64("text")).distinct().count()
    # Others never add enough.
    able = f"a - 4 * b >= {least_gain(positives)}"
    holders: dict[str, array] = {}
    toxic = terms.where("label = 1").join(rows.where(able).select("term"), "term").groupBy("row").agg(F.collect_list("term").alias("t"))
    for number, r in enumerate(toxic.toLocalIterator()):
        for t in r["t"]:
            holders.setdefault(t, array("l")).append(number)
    chosen = choose_terms([x for x in listed if _key(*x[:2]) in holders], holders, positives)
    chosen += stem_words(listed, chosen)
    first = Model(chosen, np.zeros(6), {})

    def measure(model: Model):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lexicon = Lexicon(model.terms)
            for batch in batches:
                found = [features(t.as_py(), lexicon, model.strange) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([f.tolist() for f, _ in found], pa.list_(pa.float64())), pa.array([sorted(o) for _, o in found], pa.list_(pa.string()))],
                    names=["label", "x", "odd"],
                )

        return sample.select("label", "text").mapInArrow(run, "label int, x array<double>, odd array<string>").collect()

    seen: dict[str, list[int]] = {}
    for r in measure(first):
        for form in r["odd"]:
            seen.setdefault(form, [0, 0])[r["label"]] += 1
    # Shrunk towards even; a form seen in clean texts only loses its weight.
    strange = {f: (b + 0.5) / (a + b + 1.0) for f, (a, b) in seen.items()}
    strange = {f: p if p >= 0.5 else 0.0 for f, p in strange.items()}
    found = measure(Model(chosen, np.zeros(6), strange))
    x = np.array([r["x"] for r in found])
    y = np.array([r["label"] for r in found], float)
    return Model(chosen, logistic(x, y), strange)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the constant comes last and is not penalised."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * len(x))
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, direct, misspelled, quoted of every row; without a model every score is 0.

    No exchange; whole texts, one batch in memory. Null and empty texts have no hits and get the
    score of such a text. Null and repeated ids are scored row by row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms) if model else None
        for batch in batches:
            if model is None:
                x = np.zeros((batch.num_rows, 5))
                p = np.zeros(batch.num_rows)
            else:
                x = np.array([features(t.as_py() or "", lexicon, model.strange)[0] for t in batch.column(1)]).reshape(-1, 5)
                p = 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -500, 500)))
            counts = np.expm1(x[:, :3])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), *[pa.array(counts[:, k]) for k in range(3)]],
                names=["doc_id", "score", "direct", "misspelled", "quoted"],
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double, direct double, misspelled double, quoted double")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted and the hit counts; one row per input row.

    Labels are read only for rows outside the held-out fold. Empty tables, null texts and ids,
    repeated rows and clashing extra columns: see ``fit`` and ``score``.
    """
    model = fit(docs, labels, id_col, text_col, folds, held)
    scored = score(docs, model, id_col, text_col)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "direct",
        "misspelled",
        "quoted",
    )


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, all columns as they were; no exchange."""
    model = fit(docs, labels, id_col, text_col)
    at = docs.columns.index(text_col)
    # As one struct, so columns may have any names.
    rows = docs.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms)
        for batch in batches:
            texts = batch.column(0).flatten()[at]
            x = np.array([features(t.as_py() or "", lexicon, model.strange)[0] for t in texts]).reshape(-1, 5)
            yield batch.filter(pa.array(x @ model.weights[:-1] + model.weights[-1] < 0))

    return rows.mapInArrow(run, rows.schema).select("row.*") if model else docs
