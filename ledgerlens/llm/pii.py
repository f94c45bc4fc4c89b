"""Operator 8, personal data by gradient boosting over candidate spans.

Base spans are those of four fixed patterns with their checks; they always stay. Beside them, generators of high recall
propose spans that may overlap (digit runs of any separators, spelt-out addresses); boosted trees score each by features of
its format and of its context, and a proposal is added if its calibrated probability reaches the threshold of its kind and it
doesn't overlap a base span or a likelier addition.

The trees are a classifier's fit on at most TRAIN_SPANS spans of whole documents picked by a hash of the id: base spans are
positive, proposals that base spans don't touch are negative unless they have a known variant's form (those teach nothing), and variants
made by rule from base spans (other separators, spelt-out signs; broken checks as negatives) teach both sides. A quarter of the
documents is kept for isotonic calibration and the thresholds, and half of that quarter for precision and recall of what is added.

Defined results: a null text counts as empty and has no spans; repeated rows are treated alike; a null id is allowed; without
any base span to learn from nothing is added; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import columns, map_arrow, read_table, record_batch

KINDS = ("email", "ip", "card", "phone")
#: Documents and spans to learn from at most, trees and their depth, and the precision that additions must have.
TRAIN_DOCS, TRAIN_SPANS, TREES, DEPTH, RATE, PRECISION = 20_000, 20_000, 40, 3, 0.3, 0.98

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# possessive, and from the beginning of a digit run: the same matches without running back over long digit runs
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += (d * 2 - 9 if d > 4 else d * 2) if k & 1 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octet(part: str) -> bool:
    return len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Checked matches of the four patterns, leftmost and without overlap within a kind; by start, then kind."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            found.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        found += [("card", *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_RUN = re.compile(r"[+(]?[0-9](?:[ .()/:_-]{0,2}[0-9])*+")
_SPELT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:[\[({] ?at ?[\])}]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:[\[({] ?dot ?[\])}]| dot |\.) ?[A-Za-z0-9-]{1,63}){1,6}", re.I)
_MARK = re.compile(r"[\[({] ?(?:at|dot) ?[\])}]| dot ", re.I)


def proposals(text: str) -> list[Span]:
    """Candidate spans of high recall; those of different kinds may overlap."""
    out: list[Span] = []
    if _MARK.search(text):
        out += [("email", *m.span()) for m in _SPELT.finditer(text)]
    for m in _RUN.finditer(text):
        if m.end() - m.start() < 7:
            continue
        run, start = m[0], m.start()
        pieces = {(0, len(run))}
        at = 0
        for word in run.split(" "):  # also each blank-free part, so that neighbouring numbers don't hide one another
            pieces.add((at, at + len(word)))
            at += len(word) + 1
        for a, b in pieces:
            n = len(_digits(run[a:b]))
            if 13 <= n <= 19:
                out.append(("card", start + a, start + b))
            if 9 <= n <= 15:
                out.append(("phone", start + a, start + b))
            if 4 <= n <= 12 and len([p for p in re.split(r"[.:_-]", run[a:b]) if p]) == 4 and " " not in run[a:b]:
                out.append(("ip", start + a, start + b))
    return out


HINTS = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "address", "server"), "card": ("card", "visa", "payment"), "phone": ("phone", "call", "tel", "mobile", "fax")}


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    piece, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 12]
    digits = _digits(piece)
    groups = [len(g) for g in re.findall(r"[0-9]+", piece)]
    separators = [c for c in piece if not c.isalnum()]
    touch = lambda c: 0.0 if not c else 1.0 if c.isspace() else 2.0 if c in ".,;:!?)" else 3.0 if c.isdigit() else 4.0 if c.isalpha() else 5.0
    return [
        float(KINDS.index(kind)), float(end - start), float(len(digits)), float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(luhn(digits)) if digits else -1.0, float(all(int(g or 0) <= 255 for g in re.findall(r"[0-9]{1,9}", piece))), float(piece.count(".")), float(piece.count("-")),
        float(piece.count(" ")), float(piece.count("(")), float(piece.count(":") + piece.count("/") + piece.count("_")), float(piece.startswith("+")), float(len(set(separators))),
        float(sum(c.isalpha() for c in piece)), float(bool(_MARK.search(piece))), float(piece[:1] in "3456") if digits else 0.0, touch(before[-1:]), touch(after[:1]),
        float(any(h in before.lower() for h in HINTS[kind])), float("=" in before[-4:] or '"' in before[-4:]), float(sum(c.isdigit() for c in before + after)), float(piece.count(".") == 3),
    ]


@dataclass
class Trees:
    """Boosted regression trees of the logistic loss; a node is (feature, cut, value), children stand at 2k+1 and 2k+2."""

    base: float = 0.0
    nodes: list[np.ndarray] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 17)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
        margin = np.full(len(y), self.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            tree = np.zeros((2 ** (depth + 1) - 1, 3))
            tree[:, 0] = -1
            where = np.zeros(len(y), np.int64)
            for node in range(len(tree)):
                mine = np.flatnonzero(where == node)
                if not len(mine):
                    continue
                gs, hs = g[mine].sum(), h[mine].sum()
                tree[node, 2] = -rate * gs / (hs + 1)
                best = (1e-3, -1, 0)
                if node < 2**depth - 1:
                    for j, c in enumerate(cuts):
                        gl = np.cumsum(np.bincount(binned[mine, j], g[mine], len(c) + 1))[:-1]
                        hl = np.cumsum(np.bincount(binned[mine, j], h[mine], len(c) + 1))[:-1]
                        gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                        gain[(hl < 0.1) | (hs - hl < 0.1)] = -1
                        if len(gain) and gain.max() > best[0]:
                            best = (float(gain.max()), j, int(gain.argmax()))
                if best[1] >= 0:
                    _, j, k = best
                    tree[node, :2] = j, cuts[j][k]
                    where[mine] = np.where(binned[mine, j] <= k, 2 * node + 1, 2 * node + 2)
                else:
                    margin[mine] += tree[node, 2]
            self.nodes.append(tree)
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.nodes:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                feature = tree[at, 0].astype(np.int64)
                inner = feature >= 0
                left = x[np.arange(len(x)), np.maximum(feature, 0)] <= tree[at, 1]
                at = np.where(inner, np.where(left, 2 * at + 1, 2 * at + 2), at)
            out += tree[at, 2]
        return out


def isotonic(scores: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: scores at which a step begins and its probability."""
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []  # first score, sum, count
    for s, t in zip(scores[order], y[order], strict=True):
        if blocks and blocks[-1][0] == s:
            blocks[-1][1] += t
            blocks[-1][2] += 1
        else:
            blocks.append([s, float(t), 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, t2, n2 = blocks.pop()
            blocks[-1][1] += t2
            blocks[-1][2] += n2
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _variants(text: str, span: Span, rng: random.Random) -> Iterator[tuple[str, Span, int]]:
    """The span's surroundings with another spelling of it in its place, and whether that is personal data."""
    kind, start, end = span
    piece, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 12]
    digits = _digits(piece)
    spell = lambda new, y: (before + new + after, (kind, len(before), len(before) + len(new)), y)
    draw = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == "email":
        local, _, domain = piece.partition("@")
        for at, dot in ((" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot ")):
            yield spell(local + at + domain.replace(".", dot), 1)
        yield spell(f"{local} at {domain.partition('.')[0]}. {domain[-3:]}", 0)
    elif kind == "ip":
        yield spell(piece.replace(".", rng.choice("-_:")), 0)
        yield spell(".".join(str(rng.randrange(256, 1000)) for _ in range(4)), 0)
    elif kind == "card":
        for sep in (".", "  ", "_"):
            yield spell(sep.join(digits[k : k + 4] for k in range(0, len(digits), 4)), 1)
        wrong = digits[:-1] + str((int(digits[-1]) + rng.randrange(1, 9)) % 10)
        yield spell(wrong, 0)
        yield spell(".".join(wrong[k : k + 4] for k in range(0, len(wrong), 4)), 0)
    else:
        area = digits[-10:]
        for new in (f"({area[:3]}) {area[3:6]}-{area[6:]}", f"{area[:3]}-{area[3:6]}-{area[6:]}", f"{area[:3]}.{area[3:6]}.{area[6:]}", f"00{digits[:-10]} {area[:3]} {area[3:6]} {area[6:]}"):
            yield spell(new, 1)
        yield spell(digits, 0)
        yield spell(f"20{draw(2)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)} 1{rng.randrange(9)}:{draw(2)}", 0)
        yield spell(f"{draw(3)}.{draw(6)}", 0)
        yield spell(f"{draw(4)}-{draw(4)}-{draw(4)}", 0)


#: Forms of the variants: a proposal that has one is no example of what isn't personal data.
_FORMS = {
    "email": re.compile(r"\S+ ?[\[({] ?at ?[\])}].+|\S+ at .+ dot .+", re.I),
    "card": re.compile(r"[0-9]{3,6}(?:([._]|  )[0-9]{2,6})(?:\1[0-9]{1,6})+"),
    "phone": re.compile(r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}([-.])[0-9]{3}\1[0-9]{4}|00[0-9]{1,5} [0-9]{3} [0-9]{3} [0-9]{4}"),
}


def known_form(kind: str, piece: str) -> bool:
    return kind in _FORMS and bool(_FORMS[kind].fullmatch(piece)) and (kind != "card" or luhn(_digits(piece)))


class Detector:
    """Base spans and what the fitted trees add to them. examples: surroundings, span and a number of the document, 0 or more.

    quality: by kind, precision and recall of the proposals and variants of documents that neither trees nor thresholds have seen.
    """

    def __init__(self, examples: list[tuple[str, Span, int]] | None = None) -> None:
        self.trees, self.thresholds, self.quality = None, {}, {}
        if not examples:
            return
        rng, rows = random.Random(7), []
        for text, span, doc in examples:
            base = base_spans(text)
            if span in base:
                rows.append((features(text, span), 1, span[0], doc, False))
                rows += [(features(t, s), y, s[0], doc, True) for t, s, y in _variants(text, span, rng)]
            elif not any(s[1] < span[2] and span[1] < s[2] for s in base) and not known_form(span[0], text[span[1] : span[2]]):
                rows.append((features(text, span), 0, span[0], doc, True))
        x, y, kinds = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float), np.array([r[2] for r in rows])
        part = np.array([r[3] % 8 for r in rows])
        learned, kept, unseen = part < 6, part == 6, (part == 7) & np.array([r[4] for r in rows])
        if not all(0 < y[p].sum() < p.sum() for p in (learned, kept)):
            return
        self.trees = Trees().fit(x[learned], y[learned])
        self.steps, self.chances = isotonic(self.trees.margin(x[kept]), y[kept])
        chance = self.chance(self.trees.margin(x))
        for kind in KINDS:
            mine = kept & (kinds == kind)
            c, t = chance[mine], y[mine]
            for cut in np.unique(c[c >= 0.5]):  # the lowest at which everything above is precise enough
                if t[c >= cut].mean() >= PRECISION:
                    self.thresholds[kind] = float(cut)
                    break
            asked = unseen & (kinds == kind)
            taken = asked & (chance >= self.thresholds.get(kind, 2.0))
            if asked.any():
                self.quality[kind] = (float(y[taken].mean()) if taken.any() else 1.0, float(y[taken].sum() / max(1.0, y[asked].sum())))

    def chance(self, margin: np.ndarray) -> np.ndarray:
        return self.chances[np.maximum(np.searchsorted(self.steps, margin, "right") - 1, 0)]

    def spans(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """Base spans and all spans of each text."""
        base = [base_spans(t) for t in texts]
        asked = []
        if self.trees is not None and self.thresholds:
            for k, t in enumerate(texts):
                for s in proposals(t):
                    if s[0] in self.thresholds and not any(b[1] < s[2] and s[1] < b[2] for b in base[k]):
                        asked.append((k, s))
        added: dict[int, list[tuple[float, Span]]] = {}
        if asked:
            chance = self.chance(self.trees.margin(np.array([features(texts[k], s) for k, s in asked])))
            for (k, s), c in zip(asked, chance, strict=True):
                if c >= self.thresholds[s[0]]:
                    added.setdefault(k, []).append((float(c), s))
        out = []
        for k, b in enumerate(base):
            taken = list(b)
            for _, s in sorted(added.get(k, []), key=lambda a: (-a[0], a[1][1] - a[1][2], a[1][1], KINDS.index(a[1][0]))):
                if not any(o[1] < s[2] and s[1] < o[2] for o in taken):
                    taken.append(s)
            out.append((b, sorted(taken, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))))
        return out


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_EXAMPLE = pa.schema([("near", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("draw", pa.int64())])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts, draws in columns(batches, "text", "draw"):
        rows = []
        for text, draw in zip(texts.to_pylist(), draws.to_pylist(), strict=True):
            if text and (_DIGIT.search(text) or "@" in text):
                for kind, a, b in dict.fromkeys([*base_spans(text), *proposals(text)]):
                    if b - a <= 200:
                        rows.append((text[max(0, a - 40) : b + 40], kind, min(a, 40), min(a, 40) + b - a, draw))
        if rows:
            yield record_batch(_EXAMPLE, *map(list, zip(*rows, strict=True)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Detector:
    """Learn from the spans of about TRAIN_DOCS documents, TRAIN_SPANS at most, picked by a hash of the id."""
    share = min(1.0, TRAIN_DOCS / max(1, docs.count()))
    rows = docs.select(F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)).alias("draw"))
    found = map_arrow(rows.filter(F.col("draw") < int(share * (1 << 30))), _examples, "near string, kind string, start long, end long, draw long")
    picked = found.orderBy("draw", "near", "start", "kind").limit(TRAIN_SPANS).collect()
    return Detector([(r["near"], (r["kind"], r["start"], r["end"]), r["draw"]) for r in picked])


def find(docs: DataFrame, detector: Detector, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of base spans, all spans as text and their number, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(detector)
    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string()), ("n_spans", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in columns(batches, "id", "text"):
            found = shared.value.spans([t or "" for t in texts.to_pylist()])
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS]
            yield record_batch(schema, ids, *counts, [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], [joined(spans) for _, spans in found], [len(spans) for _, spans in found])

    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(given, run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_spans long")


def redact_text(text: str, spans: list[Span]) -> str:
    """Each span replaced by its kind; overlapping spans become one, named by the first."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, detector: Detector, text_col: str = "text") -> DataFrame:
    """docs with the text redacted, all other columns as they are; a null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(detector)
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(where).to_pylist()
            found = shared.value.spans([t or "" for t in texts])
            new = pa.array([t if t is None else redact_text(t, spans) for t, (_, spans) in zip(texts, found, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([new if k == where else c for k, c in enumerate(batch.columns)], names=batch.schema.names)

    return map_arrow(docs, run, docs.schema)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return find(docs, fit(docs))
