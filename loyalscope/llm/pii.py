"""Personal data: high-recall generators propose spans, boosted trees judge them, calibrated thresholds select.

Four kinds have a strict pattern each; what these accept is always found. The generators propose looser spans that may
overlap; trees, one model a kind, learn from strict hits rewritten into looser forms, in their own contexts, what such data looks
like by format and context, and add the looser spans that reach a threshold with the precision asked for on held-out candidates.
All documents give examples; the trees grow from counts of all of them.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalscope.llm import boosting
from loyalscope.llm.common import appended, release, written

# The kinds in their order, their strict patterns, and the looser ones of the generators.
KINDS = ("email", "ip", "card", "phone")
STRICT = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
LOOSE = {
    "email": re.compile(r"[^\s@<>()\[\],;:\"]+ ?(?:@|\(at\)|\[at\]) ?[^\s@<>()\[\],;:\"]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[^\s@<>()\[\],;:.\"]+)*"),
    "ip": re.compile(r"[0-9]{1,5}(?:\.[0-9]{1,5}){2,5}(?::[0-9]+)?(?:/[0-9]+)?"),
    "card": re.compile(r"[0-9](?:[\x20./-]{0,2}[0-9]){11,21}"),
    "phone": re.compile(r"(?:\+|00)?[(]?[0-9](?:[\x20()./-]{0,2}[0-9]){7,15}"),
}
#: Words that speak for a kind when they stand just before a span.
CUES = {
    "email": ("mail", "email", "e-mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "client", "from"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "fon", "cell"),
}
PLACEHOLDER = {k: f"<{k.upper()}>" for k in KINDS}
_HINT = {"email": re.compile("@|at[)\\]]"), "ip": re.compile("[0-9]"), "card": re.compile("[0-9]"), "phone": re.compile("[0-9]")}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def valid(kind: str, span: str) -> bool:
    """Whether a match of the strict pattern counts."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in span.split("."))
    digits = re.sub("[^0-9]", "", span)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def strict_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the strict patterns: leftmost, non-overlapping for each kind, failing matches dropped."""
    found = []
    # no kind can match without one of these characters; that saves most texts the search
    kinds = [k for k in KINDS if (k == "email" and "@" in text) or (k == "phone" and "+" in text)]
    if _DIGIT.search(text):
        kinds += ["ip", "card"]
    for kind in kinds:
        for m in _matches(text, kind):
            if valid(kind, m.group()):
                found.append((m.start(), m.end(), kind))
    return sorted(found, key=_order)


def _matches(text: str, kind: str):
    """The matches of the strict pattern, in time that grows with the text however long its words are."""
    return _emails(text) if kind == "email" else _IP.finditer(text) if kind == "ip" else STRICT[kind].finditer(text)


_IP = re.compile("(?<![0-9])" + STRICT["ip"].pattern)  # a match never begins inside a number: all of it would match as well
_DIGIT = re.compile("[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str):
    """The strict e-mail matches, sought from each @ backwards, so that long words without one cost nothing.

    A match never holds a second @, so the leftmost match before an @ begins where the run of allowed characters does,
    or where the last match ended.
    """
    after = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = STRICT["email"].match(text, start) if start < at else None
        if m:
            yield m
            after = m.end()
        at = text.find("@", at + 1)


def _loose_matches(text: str, kind: str):
    """The matches of the looser pattern; e-mail addresses are sought from what joins their two parts backwards."""
    if kind != "email":
        yield from LOOSE[kind].finditer(text)
        return
    after = 0
    for joint in _JOINT.finditer(text):
        end = joint.start()
        if end < after:
            continue
        if end > after and text[end - 1] == " ":
            end -= 1
        start = end
        while start > after and not _NO_NAME.match(text, start - 1):
            start -= 1
        m = LOOSE[kind].match(text, start) if start < end else None
        if m:
            yield m
            after = m.end()


_JOINT = re.compile(r"@|\(at\)|\[at\]")
_NO_NAME = re.compile(r"[\s@<>()\[\],;:\"]")


def _order(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def proposals(text: str, kind: str) -> list[tuple[int, int]]:
    """Candidate spans of a kind, strict matches before validation included; they may overlap."""
    if not _HINT[kind].search(text):
        return []
    spans = {(m.start(), m.end()) for found in (_matches, _loose_matches) for m in found(text, kind)}
    return sorted(spans)


FEATURES = ("length", "digits", "groups", "separators", "plus", "luhn", "largest group", "smallest group", "over 255", "at", "dots",
            "last part", "letters", "space", "before", "after", "cue", "brackets", "first group", "zeros")


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of a span, and the context around it."""
    span = text[start:end]
    parts = re.findall("[0-9]+", span)
    digits = "".join(parts)
    before, after = text[start - 1 : start], text[end : end + 1]
    words = re.findall(r"[\w-]+", text[max(0, start - 40) : start].lower())[-3:]
    edge = lambda c: 0 if not c or c.isspace() else 1 if c.isdigit() else 2 if c.isalpha() else 3
    return [
        len(span), len(digits), len(parts), sum(not c.isalnum() for c in span), span[:1] == "+", len(digits) > 1 and luhn(digits),
        max(map(len, parts), default=0), min(map(len, parts), default=0), sum(len(p) < 12 and int(p) > 255 for p in parts), span.count("@"),
        span.count("."), len(re.split(r"[.@]", span)[-1]), sum(c.isalpha() for c in span), " " in span, edge(before), edge(after),
        any(w in CUES[kind] for w in words), sum(c in "()[]" for c in span), len(parts[0]) if parts else 0, sum(p[0] == "0" and len(p) > 1 for p in parts),
    ]


@dataclass
class Detector:
    """For each kind, the trees and the least probability at which a looser span counts (above 1: never)."""

    models: dict[str, boosting.Boosted]
    thresholds: dict[str, float]

    def spans(self, text: str, base: list[tuple[int, int, str]] | None = None) -> list[tuple[int, int, str]]:
        """All strict spans and the looser ones accepted, by start, then kind, then end.

        A looser span must not touch a strict span of any kind, nor a better-scored looser one of its own kind: the trees
        resolve overlapping proposals by score, then by start.
        """
        base = strict_spans(text) if base is None else base
        taken = [(a, b) for a, b, _ in base]
        out = list(base)
        for kind in KINDS:
            if self.thresholds.get(kind, 2.0) > 1 or not _HINT[kind].search(text):
                continue
            free = [(a, b) for a, b in proposals(text, kind) if not any(a < y and x < b for x, y in taken)]
            if not free:
                continue
            score = self.models[kind].probability(np.array([features(text, kind, a, b) for a, b in free], dtype=np.float64))
            for i in sorted(np.flatnonzero(score >= self.thresholds[kind]), key=lambda i: (-score[i], free[i])):
                a, b = free[i]
                if not any(a < y and x < b for x, y, k in out if k == kind):
                    out.append((a, b, kind))
        return sorted(out, key=_order)


#: Kinds that are learned. Every loose form of an address has a strict one inside, so none is learned.
LEARNED = ("email", "card", "phone")
#: Texts without any of this have neither a strict nor a looser span.
_ANY = r"[0-9@]|[(\[]at[)\]]"
_AT, _DOT = re.compile(r" ?(?:\(at\)|\[at\]|@) ?"), re.compile(r" ?(?:\(dot\)|\[dot\]) ?")


def rewritten(kind: str, span: str, cue: bool) -> list[tuple[str, bool]]:
    """Looser forms of a strict span, and likenesses of it that fail validation: (form, whether it is personal data)."""
    if kind == "email":
        name, host = span.split("@")
        dotted = [(f"{name}{at}{host.replace('.', dot)}", True) for at, dot in ((" (at) ", " (dot) "), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" (at) ", "."), ("[at]", "."))]
        return dotted + [(f"{name}{at}{host.split('.')[0]}", False) for at in (" (at) ", "[at]")]
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        return [(sep.join(d[i : i + 4] for i in range(0, len(d), 4)), d == digits) for d in (digits, wrong) for sep in (".", "/", " / ", ". ")]
    if kind == "phone":
        forms = [span[1:], "00" + span[1:], *(p + sep.join(groups) for p in ("", "00") for sep in (".", "-", "/", " "))]
        return [(x, cue or not x.isdigit()) for x in dict.fromkeys(forms)] + [(digits, cue), (digits[:9], False), ("-".join(groups)[:9], False)]
    return []


def _unsure(text: str, kind: str, start: int, end: int) -> bool:
    """Whether a looser span of the corpus itself may well be personal data: it is no example of either kind."""
    span = text[start:end]
    if kind == "email":
        return STRICT[kind].match(_DOT.sub(".", _AT.sub("@", span, count=1))) is not None
    digits = re.sub("[^0-9]", "", span)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "phone" and 10 <= len(digits) <= 15 and (span[:2] in ("00", "+0") or "(" in span or bool(features(text, kind, start, end)[FEATURES.index("cue")]))


def examples(text: str) -> list[tuple[str, list[float], bool]]:
    """(kind, features, whether personal data): the looser spans of the text itself, which count as none, and those about its
    strict spans, rewritten where they stand. A number of one kind is none of another."""
    strict = strict_spans(text)
    out = []
    for kind in LEARNED:
        out += [(kind, features(text, kind, a, b), False) for a, b in proposals(text, kind)
                if not any(a < y and x < b for x, y, _ in strict) and not _unsure(text, kind, a, b)]
    for a, b, kind in strict:
        if kind not in LEARNED:
            continue
        cue = bool(features(text, kind, a, b)[FEATURES.index("cue")])
        before, after = text[max(0, a - 60) : a], text[b : b + 20]
        for form, right in rewritten(kind, text[a:b], cue):
            new, start, end = before + form + after, len(before), len(before) + len(form)
            taken = strict_spans(new)
            for x, y in proposals(new, kind):
                if x < end and start < y and not any(x < q and p < y for p, q, _ in taken):
                    whole = x == start and y >= end and not new[end:y].strip(".!?'")
                    out.append((kind, features(new, kind, x, y), right and whole))
            other = {"card": "phone", "phone": "card"}.get(kind)
            out += [(other, features(new, other, x, y), False) for x, y in (proposals(new, other) if other else [])
                    if x < end and start < y and not any(x < q and p < y for p, q, _ in taken)]
    return out


def _counter(schema: str, of):
    """For mapInArrow: the sums of n and good over rows that of(batch) makes alike, (key, n, good) by (key, n, good), batch by batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            sums: dict[tuple, list[int]] = {}
            for key, n, good in of(batch):
                have = sums.setdefault(key, [0, 0])
                have[0] += n
                have[1] += good
            rows = [(*key, *both) for key, both in sums.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)
        release()

    return run


def _summed(rows: DataFrame, schema: str, of) -> DataFrame:
    keys = [c.split()[0] for c in schema.split(", ")]
    return rows.mapInArrow(_counter(f"{schema}, n long, good long", of), f"{schema}, n long, good long").groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"))


def _columns(batch, *names: str) -> list[list]:
    return [batch.column(name).to_pylist() for name in names]


def candidates(docs: DataFrame) -> DataFrame:
    """Rows (kind, held, x, n, good): the different features, as integers in a row, of the examples of all documents, how many there
    are of each and how many of these are personal data; held: those of every third document, by a hash of doc_id."""
    held = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("held")), F.lit(3)) == 0

    def counted(batch):
        for text, held in zip(*_columns(batch, "text", "held")):
            for kind, x, right in examples(text):
                yield (kind, held, np.array(x, "<i4").tobytes()), 1, int(right)

    some = docs.where(F.col("text").rlike(_ANY)).select("text", held.alias("held"))
    return _summed(some, "kind string, held boolean, x binary", counted)


def _matrix(values: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(len(values), len(FEATURES))


def _cuts(rows: DataFrame) -> dict[str, list[np.ndarray]]:
    """The quantiles of each feature of each kind at 32 even shares, from counts of all its values."""
    def values(batch):
        for kind, x, n in zip(*_columns(batch, "kind", "x", "n")):
            for f, value in enumerate(np.frombuffer(x, "<i4").tolist()):
                yield (kind, f, value), n, 0

    by = Window.partitionBy("kind", "feature")
    upto = F.sum("n").over(by.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = _summed(rows, "kind string, feature int, value int", values).withColumns({"upto": upto, "last": F.sum("n").over(by) - 1})
    # of the places floor(j * last / 32), j < 32, the first that is not before this value is a row of it
    j = F.expr(f"least((({boosting.CUTS} * (upto - n) + greatest(last, 1) - 1) div greatest(last, 1)), {boosting.CUTS})")
    kept = found.where((j < boosting.CUTS) & (F.floor(j * F.col("last") / boosting.CUTS) < F.col("upto")))
    cuts = {kind: [[] for _ in FEATURES] for kind in LEARNED}
    for row in kept.select("kind", "feature", "value").orderBy("kind", "feature", "value").collect():
        cuts[row.kind][row.feature].append(row.value)
    return {kind: [np.array(c, np.int64) for c in several] for kind, several in cuts.items()}


#: Different rows of bins, without held-out ones, up to which the trees grow on the driver (24 bytes each) rather than by jobs.
FEW = 100_000


def _spread(rows: DataFrame):
    """The measure for boosting.grown() by a job over all rows (kind, b, n, good); sums of each cell come back."""
    def measure(models, trees, nodes):
        size = {kind: (3, len(several), len(FEATURES), boosting.CUTS + 1) for kind, several in nodes.items()}

        def run(batches):
            sums = {kind: np.zeros(shape, np.int64) for kind, shape in size.items()}
            for batch in batches:
                kinds = np.array(batch.column("kind").to_pylist(), object)
                b = _matrix(batch.column("b").to_pylist(), np.uint8)
                n, good = (batch.column(c).to_numpy() for c in ("n", "good"))
                for kind in sums:
                    on = kinds == kind
                    if on.any():
                        sums[kind] += boosting.histograms(b[on], n[on], good[on], models[kind].margin(b[on]), trees[kind], nodes[kind])
            for kind, s in sums.items():
                cell = np.flatnonzero(s)
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(cell), pa.string()), pa.array(cell, pa.int64()), pa.array(s.ravel()[cell], pa.int64())], names=["kind", "cell", "n"])
            release()

        out = {kind: np.zeros(shape, np.int64) for kind, shape in size.items()}
        found = rows.where(F.col("kind").isin(list(nodes))).mapInArrow(run, "kind string, cell long, n long").groupBy("kind", "cell").agg(F.sum("n").alias("n")).toArrow()
        for kind, cell, n in zip(*_columns(found, "kind", "cell", "n")):
            out[kind].flat[cell] = n
        return out

    return measure


#: Steps of a score: the thresholds tried.
STEPS = 1 << 16


def train(docs: DataFrame, precision: float = 0.995) -> Detector:
    """Fit the trees on the examples of all documents, those of every third one held out.

    Examples are counted by their features, then by bins of these. The threshold of a kind is the least score, in steps of 1 / 65,536,
    from which on at least `precision` of the held-out examples are right; with fewer than 20 right ones held out, nothing but
    strict spans counts for the kind.
    """
    counted = written(candidates(docs), "examples")
    cuts = _cuts(counted.where("not held"))

    def bins(batch):
        for kind, held, x, n, good in zip(*_columns(batch, "kind", "held", "x", "n", "good")):
            at = [int(np.searchsorted(c, v)) for c, v in zip(cuts[kind], np.frombuffer(x, "<i4").tolist())]
            yield (kind, held, bytes(at)), n, good

    rows = written(_summed(counted, "kind string, held boolean, b binary", bins), "bins")
    learned = rows.where("not held").select("kind", "b", "n", "good")
    start = {kind: (0, 0) for kind in LEARNED}
    several = 0
    for r in learned.groupBy("kind").agg(F.count("*").alias("rows"), F.sum("n").alias("n"), F.sum("good").alias("good")).collect():
        start[r.kind] = (r.n, r.good)
        several += r.rows
    models = boosting.grown(start, _here(learned) if several <= FEW else _spread(learned))

    def steps(batch):
        kinds = np.array(batch.column("kind").to_pylist(), object)
        b = _matrix(batch.column("b").to_pylist(), np.uint8)
        n, good = (batch.column(c).to_numpy() for c in ("n", "good"))
        for kind, model in models.items():
            on = np.flatnonzero(kinds == kind)
            for step, i in zip(np.floor(model.probability(b[on]) * STEPS).astype(int).tolist() if len(on) else [], on.tolist()):
                yield (kind, max(step, STEPS // 2 - 1)), int(n[i]), int(good[i])

    held = _summed(rows.where("held"), "kind string, step int", steps).orderBy("kind", F.desc("step")).collect()
    detector = Detector({kind: boosting.valued(model, cuts[kind]) for kind, model in models.items()}, {})
    for kind in LEARNED:
        detector.thresholds[kind] = _threshold([(r.step, r.n, r.good) for r in held if r.kind == kind], precision)
    release()
    return detector


def _here(rows: DataFrame):
    """The measure for rows few enough for the driver."""
    table = rows.toArrow()
    kinds = np.array(table.column("kind").to_pylist(), object)
    b = _matrix(table.column("b").to_pylist(), np.uint8)
    n, good = (table.column(c).to_numpy() for c in ("n", "good"))
    return boosting.measured({kind: (b[kinds == kind], n[kinds == kind], good[kinds == kind]) for kind in LEARNED})


def _threshold(steps: list[tuple[int, int, int]], precision: float) -> float:
    """From (step, examples, right ones), the largest step first; steps below a probability of one half are one, which is none."""
    if sum(good for _, _, good in steps) < 20:
        return 2.0
    least, n, right = 2.0, 0, 0
    for step, some, good in steps:
        n, right = n + some, right + good
        if 2 * step >= STEPS and right >= precision * n:
            least = step / STEPS
    return least


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def find(docs: DataFrame, detector: Detector) -> DataFrame:
    """All columns of docs with n_email, n_ip, n_card, n_phone (strict spans), base_sha256 and spans.

    spans lists kind:start:end of all spans by start, then kind; offsets are code points, the end exclusive. Whole texts are
    searched; null and empty texts have no spans. Repeated rows get equal answers, an empty table gives no rows, columns of
    docs with the names of the new ones are replaced. The trees are some kilobytes and go to the tasks with the function.
    """

    def compute(batch):
        counts, digests, lists = [[] for _ in KINDS], [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            base = strict_spans(text)
            for kind, column in zip(KINDS, counts):
                column.append(sum(s[2] == kind for s in base))
            digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
            lists.append(listed(detector.spans(text, base)))
        return [*counts, digests, lists]

    return appended(docs, compute, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact_text(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with a placeholder for each span; overlapping spans become one, with the placeholder of the first."""
    out, at = [], 0
    for a, b, kind in spans:
        if a < at:
            at = max(at, b)
            continue
        out += [text[at:a], PLACEHOLDER[kind]]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, detector: Detector) -> DataFrame:
    """The columns of docs, all spans in text replaced by placeholders. Null stays null."""

    def compute(batch):
        out = []
        for text in batch.column("_given_text"):
            text = text.as_py()
            spans = detector.spans(text) if text else []
            out.append(redact_text(text, spans) if spans else text)
        return [out]

    return appended(docs, compute, "text string").select(*docs.columns)
