"""Personal data by fixed patterns and a skip-chain conditional random field.

The base spans are those of four patterns (e-mail, IP address, card, phone), found
leftmost first and without overlap within a kind; a match that fails its check is
dropped and not retried.

The field labels the tokens of a document that hold a digit or an at sign; all others
are outside by construction, which cuts the chain there. Neighbouring tokens share a
chain potential; tokens that are equal, or alike (same letters and digits, same local
part, same last digits), share a skip potential however far apart they stand (each
occurrence is linked to the first one, so links grow with the tokens and any two occurrences are two links apart). Weights are
learnt by pseudo-likelihood from base spans of at most ``SAMPLE_DOCS`` documents (and tokens and stretches of
tokens there that are base spans when read alone, so that the patterns' failures are not learnt); token shapes and
neighbours' labels are hidden at random while learning, so that neither stands in for the other. Skip weights have a Gaussian prior around ``SKIP_PRIOR``: where a
sample repeats no token, there is nothing else to learn them from. Inference is damped loopy sum-product, until the messages settle;
the labels of tokens under base spans are given.

Tokens that touch no base span and whose label is surer than ``SURE`` can become spans. Neighbours of one
label that pass their kind's pattern and check when read on their own are one span: a phone
number and a card side by side, say, are one failing match to both patterns. A run that fails as a whole
is read from left to right, and the longest stretch of its tokens that passes from a token on is a span. Any other
such token becomes a span if it is linked, over any number of skip links, to a token under a base
span of its kind.

A null text is empty and has no span. An empty table gives an empty result; null ids
and repeated rows are kept; other columns are not read (or travel in a struct).
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectorlens.llm.common import forest, text_slices, whole_text

KINDS = ["email", "ip", "card", "phone"]
SAMPLE_DOCS, SURE = 1500, 0.9
#: Prior weight of a link between equal tokens, and between alike ones.
SKIP_PRIOR = np.array([3.0, 2.0])

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match begins where a run of digits begins: inside a run the rest would fail or match alike
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ACTIVE = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_TOKEN_END = re.compile(r"[^\x20\x09-\x0D]*")


def luhn(digits: str) -> bool:
    values = [ord(c) - 48 for c in digits[::-1]]
    return (sum(values[::2]) + sum(v * 2 - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match ends its local part at an at sign, so those are gone through."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and (c := text[start - 1]) < "\x7f" and (c.isalnum() or c in "._%+-"):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = max(free, at)
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """kind, start, end (code points, end exclusive), by start and then kind."""
    out = [("email", a, b) for a, b in emails(text)]
    if _ACTIVE.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# ---------------------------------------------------------------- tokens and their graph

FEATURES = 40


def tokens(text: str) -> list[tuple[int, int]]:
    """Tokens (between white space) that hold a digit or an at sign, without outer punctuation."""
    out, done = [], 0
    for m in _ACTIVE.finditer(text):
        if m.start() < done:
            continue
        start = m.start()
        while start > done and not _SPACE.match(text[start - 1]):
            start -= 1
        done = _TOKEN_END.match(text, m.start()).end()
        a, b = start, done
        while a < b and text[a] in "([<{\"',;:":
            a += 1
        while b > a and text[b - 1] in ")]>}\"',;:.!?":
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def shape(token: str) -> list[int]:
    """Places of a token's features."""
    digits = [c for c in token if "0" <= c <= "9"]
    n, dots = len(digits), min(4, token.count("."))
    bucket = next(i for i, top in enumerate((0, 1, 2, 3, 4, 6, 8, 11, 19, 10**9)) if n <= top)
    out = [0, 1 + bucket, 11 + dots]
    tests = [
        "@" in token, bool(_DOMAIN.fullmatch(token.rpartition("@")[2])) and "@" in token, "-" in token,
        token[0] == "+", any(c.isalpha() for c in token), n == len(token),
        dots == 3 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in token.split(".")) and token.count(".") == 3,
        12 <= n <= 19 and luhn("".join(digits)), n == len(token) and 3 <= n <= 4, ")" in token, "/" in token, ":" in token,
        n * 2 > len(token),
    ]
    return out + [16 + i for i, x in enumerate(tests) if x]


def similar_keys(token: str) -> list[str]:
    """What tokens have in common that are alike without being equal."""
    plain = "".join(c for c in token.lower() if c.isalnum())
    digits = "".join(c for c in token if "0" <= c <= "9")
    keys = ["a" + plain]
    if "@" in token and token[0] != "@":
        keys.append("l" + token.partition("@")[0].lower())
    if len(digits) >= 7:
        keys.append("d" + digits[-7:])
    return keys


class Graph:
    """Tokens of many documents, their features, chain links and skip links."""

    def __init__(self):
        self.spans, self.places, self.docs, self.gold = [], [], [], []
        self.chain, self.equal, self.alike = [], [], []

    def add(self, doc: int, text: str, base: list[tuple[str, int, int]], teach: bool = False) -> None:
        """The tokens of one more document. To ``teach``, tokens that are base spans when read alone are gold as well."""
        before, first = None, {}
        reached, start, linked = 0, len(self.spans), len(self.chain)
        taken = sorted((a, b, KINDS.index(k) + 1) for k, a, b in base)
        for a, b in tokens(text):
            node = len(self.spans)
            token = text[a:b]
            while reached < len(taken) and taken[reached][1] <= a:
                reached += 1
            label = next((k for x, y, k in taken[reached : reached + 4] if x < b and a < y), 0)
            if teach and not label:
                label = next((KINDS.index(k) + 1 for k, x, y in base_spans(token) if (x, y) == (0, b - a)), 0)
            self.spans.append((a, b))
            self.places.append(shape(token) + [FEATURES - 1] * (text[max(0, a - 1) : a] == "("))
            self.docs.append(doc)
            self.gold.append(label)
            if before is not None and a - before[1] <= 3 and text[before[1] : a].strip(" ()-,.;:") == "":
                self.chain.append((before[0], node))
            if (at := first.setdefault("=" + token, node)) != node:
                self.equal.append((at, node))
            for key in similar_keys(token):
                if (other := first.setdefault(key, node)) not in (at, node):
                    self.alike.append((other, node))
            before = (node, b)
        if teach:
            self.teach_parts(text, start, dict(self.chain[linked:]))

    def teach_parts(self, text: str, start: int, follows: dict[int, int]) -> None:
        """Stretches of unlabelled neighbours from node ``start`` on that pass when read alone are gold."""
        run: list[int] = []
        for i in [*range(start, len(self.spans)), -1]:
            if run and (i < 0 or self.gold[i] or follows.get(run[-1]) != i or text[self.spans[i][0]] == "+"):
                kind = "phone" if text[self.spans[run[0]][0]] == "+" else "card"
                for part in parts(text, self, kind, run):
                    if len(part) > 1:
                        for j in part:
                            self.gold[j] = KINDS.index(kind) + 1
                run = []
            if i >= 0 and not self.gold[i]:
                run.append(i)

    def features(self) -> np.ndarray:
        out = np.zeros((len(self.places), FEATURES))
        for i, places in enumerate(self.places):
            out[i, places] = 1
        return out

    def links(self, kind: str) -> np.ndarray:
        return np.array(getattr(self, kind), np.int64).reshape(-1, 2)


LABELS = len(KINDS) + 1
#: What speaks against any other label where a label is given: more than all messages together.
GIVEN = 1e9


def learn(graph: Graph, rounds: int = 300, rate: float = 0.5, l2: float = 1e-3) -> dict[str, np.ndarray]:
    """Weights that maximise the pseudo-likelihood of the gold labels (full-batch gradient steps)."""
    x, y = graph.features(), np.array(graph.gold, np.int64)
    w = {"unary": np.zeros((FEATURES, LABELS)), "chain": np.zeros((LABELS, LABELS)), "skip": SKIP_PRIOR.copy()}
    if not len(y):
        w["unary"][0, 0] = 5.0  # nothing seen: everything is outside
        return w
    random = np.random.default_rng(3)
    one = np.eye(LABELS)[y]
    linked, skips = graph.links("chain"), [graph.links("equal"), graph.links("alike")]
    votes = []
    for link in skips:
        v = np.zeros((len(y), LABELS))
        np.add.at(v, link[:, 0], one[link[:, 1]])
        np.add.at(v, link[:, 1], one[link[:, 0]])
        votes.append(v)
    speed = {k: np.full_like(v, 1e-8) for k, v in w.items()}
    for _ in range(rounds):
        shown = x * (random.random(x.shape[0]) > 0.1)[:, None]
        shown[:, 0] = 1
        # neighbours' labels are shown now and then only: a token's own shape must do for most of it
        chain = linked[random.random(len(linked)) > 0.7]
        logits = shown @ w["unary"] + w["skip"][0] * votes[0] + w["skip"][1] * votes[1]
        np.add.at(logits, chain[:, 1], w["chain"][y[chain[:, 0]]])
        np.add.at(logits, chain[:, 0], w["chain"][:, y[chain[:, 1]]].T)
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (one - p) / len(y)
        step = {"unary": shown.T @ d, "skip": np.array([(d * v).sum() for v in votes]), "chain": np.zeros((LABELS, LABELS))}
        np.add.at(step["chain"], y[chain[:, 0]], d[chain[:, 1]])
        np.add.at(step["chain"].T, y[chain[:, 1]], d[chain[:, 0]])
        for k in w:
            g = step[k] - l2 * (0.01 * w[k] if k != "skip" else w[k] - SKIP_PRIOR)
            speed[k] += g * g
            w[k] += rate * g / np.sqrt(speed[k])
    w["skip"] = np.maximum(w["skip"], 0)
    return w


def marginals(graph: Graph, w: dict[str, np.ndarray], rounds: int = 500, damping: float = 0.3, settled: float = 1e-6) -> np.ndarray:
    """Label probabilities of every token: damped loopy sum-product over chain and skip links.

    Gold labels are given. Rounds end when no message changes by more than ``settled``; messages on
    loops need not settle, so there are ``rounds`` at most.
    """
    unary = graph.features() @ w["unary"]
    known, gold = np.flatnonzero(graph.gold), np.array(graph.gold, np.int64)
    unary[known] = -GIVEN
    unary[known, gold[known]] = 0
    links = [graph.links(k) for k in ("chain", "equal", "alike")]
    tables = [w["chain"], np.eye(LABELS) * w["skip"][0], np.eye(LABELS) * w["skip"][1]]
    source = np.concatenate([x for l in links for x in (l[:, 0], l[:, 1])])
    target = np.concatenate([x for l in links for x in (l[:, 1], l[:, 0])])
    count = [len(l) for l in links]
    message = np.zeros((len(source), LABELS))
    starts = np.cumsum([0, *[c for n in count for c in (n, n)]])
    back = np.concatenate([np.arange(starts[i ^ 1], starts[i ^ 1] + count[i // 2]) for i in range(6)]) if len(source) else None

    def beliefs():
        b = unary.copy()
        if len(source):
            np.add.at(b, target, message)
        return b

    for _ in range(rounds if len(source) else 0):
        cavity = beliefs()[source] - message[back]
        fresh = np.empty_like(message)
        for i in range(6):
            part = slice(starts[i], starts[i + 1])
            pair = tables[i // 2] if i % 2 == 0 else tables[i // 2].T
            both = cavity[part][:, :, None] + pair[None]
            top = both.max(axis=1)
            fresh[part] = top + np.log(np.exp(both - top[:, None, :]).sum(axis=1))
        fresh -= fresh.max(axis=1, keepdims=True)
        change = np.abs(fresh - message).max()
        message = damping * message + (1 - damping) * fresh
        if change <= settled:
            break
    b = beliefs()
    p = np.exp(b - b.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def passes(text: str, kind: str, a: int, b: int) -> bool:
    """Whether the stretch, read on its own, is a base span of ``kind`` as a whole."""
    return (kind, 0, b - a) in base_spans(text[a:b])


def runs(text: str, graph: Graph, labels: np.ndarray, follows: dict[int, int], nodes: list[int]) -> Iterator[list[int]]:
    """``nodes`` (ascending, of one document) in runs of neighbours with one label; a plus sign begins a run of its own."""
    run: list[int] = []
    for i in nodes:
        if run and (follows.get(run[-1]) != i or labels[i] != labels[run[-1]] or text[graph.spans[i][0]] == "+"):
            yield run
            run = []
        run.append(i)
    if run:
        yield run


#: No card and no phone has more digits.
MOST_DIGITS = 19


def parts(text: str, graph: Graph, kind: str, run: list[int]) -> Iterator[list[int]]:
    """``run`` cut from left to right into the longest stretches that pass; tokens in none stand alone."""
    digits = [max(1, sum("0" <= c <= "9" for c in text[a:b])) for a, b in (graph.spans[i] for i in run)]
    at = 0
    while at < len(run):
        end, total = at + 1, digits[at]
        # an address has no white space, so it is one token
        while kind in ("card", "phone") and end < len(run) and total + digits[end] <= MOST_DIGITS:
            total += digits[end]
            end += 1
        while end > at + 1 and not passes(text, kind, graph.spans[run[at]][0], graph.spans[run[end - 1]][1]):
            end -= 1
        yield run[at:end]
        at = end


def find_spans(texts: list[str], w: dict[str, np.ndarray]) -> list[tuple[list, list]]:
    """For each text its base spans, and all spans."""
    base = [base_spans(t) for t in texts]
    graph = Graph()
    for i, (text, spans) in enumerate(zip(texts, base)):
        if _ACTIVE.search(text):
            graph.add(i, text, spans)
    added = defaultdict(list)
    if graph.spans:
        p, gold = marginals(graph, w), np.array(graph.gold)
        best = p.argmax(axis=1)
        links = np.concatenate([graph.links("equal"), graph.links("alike")])
        group = forest(len(gold), links[:, 0], links[:, 1])
        proof = set(zip(group[gold > 0].tolist(), gold[gold > 0].tolist()))
        # a token under a base span is settled; only others can become spans
        free = defaultdict(list)
        for i in np.flatnonzero((best > 0) & (gold == 0) & (p.max(axis=1) > SURE)).tolist():
            free[graph.docs[i]].append(i)
        follows = dict(graph.chain)
        for doc, nodes in free.items():
            text = texts[doc]
            for run in runs(text, graph, best, follows, nodes):
                kind, (a, b) = KINDS[best[run[0]] - 1], (graph.spans[run[0]][0], graph.spans[run[-1]][1])
                if passes(text, kind, a, b):
                    added[doc].append((kind, a, b))
                    continue
                for part in parts(text, graph, kind, run):
                    i, (a, b) = part[0], (graph.spans[part[0]][0], graph.spans[part[-1]][1])
                    if len(part) > 1 or (int(group[i]), int(best[i])) in proof or passes(text, kind, a, b):
                        added[doc].append((kind, a, b))
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return [(b, sorted([*b, *added[i]], key=order)) for i, b in enumerate(base)]


def fit(docs: DataFrame) -> dict[str, np.ndarray]:
    """Weights learnt in one task from ``SAMPLE_DOCS`` documents that hold a digit or an at sign (all, if there are fewer)."""
    active = docs.filter(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64(F.lit(41), "doc_id", "text").alias("at"))
    # the greatest hash of the sample is found on the narrow column, so that few texts are sorted
    last = active.select("at").orderBy("at").limit(SAMPLE_DOCS).agg(F.coalesce(F.max("at"), F.lit(0))).first()[0]
    thin = active.filter(F.col("at") <= F.lit(last).cast("long")).orderBy("at").limit(SAMPLE_DOCS).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, n = Graph(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                graph.add(n, text, base_spans(text), teach=True)
                n += 1
        w = learn(graph)
        flat = np.concatenate([w["unary"].ravel(), w["chain"].ravel(), w["skip"]])
        yield pa.RecordBatch.from_pydict({"w": pa.array([flat], pa.list_(pa.float64()))})

    found = thin.coalesce(1).mapInArrow(run, "w array<double>").first()
    if found is None:  # no such document, and so no task
        return learn(Graph())
    flat = np.array(found[0])
    a, b = FEATURES * LABELS, FEATURES * LABELS + LABELS * LABELS
    return {"unary": flat[:a].reshape(FEATURES, LABELS), "chain": flat[a:b].reshape(LABELS, LABELS), "skip": flat[b:]}


SPAN = "array<struct<kind:string,start:int,end:int>>"


def detect(docs: DataFrame, kept: list, types: str, w: dict[str, np.ndarray] | None = None) -> DataFrame:
    """The columns ``kept`` with base and spans: the patterns' spans, and all spans."""
    w = fit(docs) if w is None else w
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    as_rows = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, column=0):
            found = find_spans(batch.column(0).to_pylist(), w)
            columns = [pa.array([as_rows(x[i]) for x in found], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], [*batch.schema.names[1:], "base", "spans"])

    return docs.select(whole_text().alias("text"), *kept).mapInArrow(run, f"{types}, base {SPAN}, spans {SPAN}")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans are one."""
    out, free = [], 0
    for kind, a, b in spans:
        if a >= free:
            out += [text[free:a], f"<{kind.upper()}>"]
        free = max(free, b)
    return "".join([*out, text[free:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in the text (n_chars follows it); a null text stays null."""
    w = fit(docs)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at = docs.columns.index("text")
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, column=at):
            texts = batch.column(at).to_pylist()
            found = find_spans([t or "" for t in texts], w)
            new = [None if t is None else masked(t, x[1]) for t, x in zip(texts, found)]
            columns = list(batch.columns)
            columns[at] = pa.array(new, pa.string())
            if counted is not None:
                columns[counted] = pa.array([None if t is None else len(t) for t in new], batch.schema.field(counted).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, types)
