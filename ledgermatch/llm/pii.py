"""Personal data by weak supervision.

Candidates.  Base spans of four kinds (email, ip, card, phone) come from fixed patterns, as
documented at ``base_spans``.  Generators of their own propose what those patterns miss:
addresses written with "at" and "dot" or with spaces, IPv6 addresses and IPv4 addresses with
spaced or bracketed dots, account numbers (IBAN), cards of 13 digits, with other separators or
with a wrong check digit, and telephone numbers as they are written within a country.

Votes.  Four labelers look at each candidate, base or not, and vote for, against or not at
all: a form labeler (does it follow the rules of what it looks like: check digits, numbering
plan, address syntax?), a gazetteer labeler (top-level domains, card issuers and IBAN
countries, calling codes and area codes, special-use address blocks), a cue labeler (words
near the candidate, on both sides, that name the kind) and a surroundings labeler (is it part
of a longer name, or announced as something else, such as an order or a version?).  None of
them asks whether the candidate is a base span.

Model.  Votes and features are small integers, so the corpus is gathered as counts by
(kind, votes, features): a table whose size is bounded by the number of such combinations,
whatever the number of documents.  Expectation-maximisation over the counts of all documents
estimates each labeler's reliability per kind (one latent class model per kind), and a
logistic span classifier is fitted to the posteriors.  Its decision adds spans; base spans
always stay, and an added span never overlaps a kept one.

Null texts count as empty; such documents have no spans.  Whole texts are searched; each
search is linear in the length of the text.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, chain, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base spans.  The look-behinds only skip starts from which
# the same run of characters has been tried already.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DIGIT = re.compile(r"[0-9]")

# Wider candidates.  Each pattern has bounded repeats only, so a search is linear.
_AT = r"(?: ?(?:\[at\]|\(at\)|\{at\}) ?| at | ?@ ?)"
_DOT = r"(?: ?(?:\[dot\]|\(dot\)|\{dot\}|\[\.\]|\(\.\)) ?| dot | ?\. ?)"
_SPOKEN = re.compile(rf"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{{1,64}}{_AT}[a-z0-9-]{{1,63}}(?:{_DOT}[a-z0-9-]{{2,63}}){{1,4}}")
#: A text without one of these has no such address but base ones.
_SPOKEN_SIGN = re.compile(r"(?i) dot |[\[({](?:at|dot|\.)[\])}]| @|@ ")
_V6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
_V4 = re.compile(r"(?i)(?<![0-9.])[0-9]{1,3}(?:(?: ?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)) ?| \. ?| dot )[0-9]{1,3}){3}(?![0-9])")
_ACCOUNT = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")
_CARD_OTHER = re.compile(r"(?<![0-9A-Za-z.])(?:[0-9]{4}(?:[./_][0-9]{4}){2}[./_][0-9]{1,7}|4[0-9]{12})(?![0-9A-Za-z])")
_NATIONAL = re.compile(
    r"(?<![0-9A-Za-z.+-])(?:"
    r"(?P<north>(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})"
    r"|(?P<pairs>0[1-9](?:[ .-]?[0-9]{2}){4})"
    r"|(?P<area>0[0-9]{2,4}(?: ?/ ?| |-)[0-9]{3,8}(?:[ -][0-9]{1,5})?)"
    r"|(?P<nine>[6789][0-9]{2}(?:(?:[ .-]?[0-9]{3}){2}|(?:[ .-][0-9]{2}){3}))"
    r"|(?P<exit>00[1-9][0-9]{0,2}(?:[ .()-]{1,2}[0-9]{1,8}){1,4})"
    r"|(?P<loose>(?:\([0-9]{2,4}\)[ -]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4})"
    r")(?![0-9A-Za-z])(?![.-][0-9])"
)
#: Generators, by number: the feature "form" of a candidate.
FORMS = ("base", "spoken", "v6", "v4", "run", "account", "card", "north", "pairs", "area", "nine", "exit", "loose")

# The gazetteers.
_TLDS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au jp cn in br ru ch at be se no".split())
_ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "36", "38", "30", "6011", "65", "35", "62")
_COUNTRIES = frozenset("AD AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK SM".split())
_CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "57", "61", "64", "81", "82", "86", "90", "91")
_RESERVED = ("0.", "127.", "255.", "::", "fe80", "ff0")
_CUES = {
    "email": ("mail", "contact", "correo", "courriel", "kontakt", "write to", "écri", "escrib", "schreib"),
    "ip": ("ip", "address", "server", "host", "login", "adresse", "servidor", "serveur", "dirección"),
    "card": ("card", "visa", "credit", "tarjeta", "carte", "karte", "iban", "account", "konto", "compte", "cuenta", "bank", "cvv"),
    "phone": ("phone", "tel", "call", "mobile", "mobil", "fax", "teléfono", "téléphone", "llam", "appel", "anruf", "whatsapp", "móvil", "handy"),
}
_OTHER_THINGS = ("order", "invoice", "version", "isbn", "ref", "serial", "ticket", "tracking", "article", "bestell", "rechnung", "commande", "facture", "pedido", "factura", "page", "time", "date")
#: Characters before and after a candidate that the labelers of its context read.
WINDOW, AFTER = 32, 20
#: The probability from which a span is added.
THRESHOLD = 0.9


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from each @ backwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Base spans (start, end, kind) by start, then kind as listed; code points, end exclusive.

    Leftmost and not overlapping per kind; a match that fails its check is dropped and not
    tried again: ip parts are at most 255, a card has 14 to 19 digits that pass Luhn, a phone
    number 10 to 15 digits.
    """
    found = [(a, b, 0) for a, b in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            found += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                found.append((m.start(), m.end(), 2))
        if "+" in text:
            found += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    found.sort(key=lambda s: (s[0], s[2]))
    return [(a, b, KINDS[k]) for a, b, k in found]


@dataclass(frozen=True)
class Candidate:
    """A possible span: its place, whether the base patterns have it, votes (1, 0 or -1 each) and features (small ints)."""

    start: int
    end: int
    kind: str
    base: bool
    votes: tuple[int, int, int, int]
    features: tuple[int, ...]


def _iban(found: str) -> bool:
    """Does an account number pass its check (remainder 1 modulo 97)?"""
    plain = found.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _address(found: str) -> bool:
    """Is it an IP address by the rules?"""
    plain = re.sub(r"(?i)[\[\](){}\s]|(?<=[0-9\s\[(])dot(?=[0-9\s\])])", lambda m: "." if m[0].lower() == "dot" else "", found)
    try:
        ipaddress.ip_address(".".join(p.lstrip("0") or "0" for p in plain.split(".")) if "." in plain else plain)
    except ValueError:
        return False
    return True


def _form(kind: str, form: str, found: str, digits: str) -> int:
    """Does a candidate keep the rules of what it looks like?"""
    if kind == "email":
        host = re.split(r"(?i)@| at |[\[({]at[\])}]", found, maxsplit=1)[-1]
        if re.search(r"(?i) at ", found) and re.search(r"\.(?![\])}])", host):
            return -1  # a sentence, not an address read out
        labels = [x for x in re.split(r"(?i) ?[\[({](?:dot|\.)[\])}] ?| dot | ?\. ?", host.strip()) if x]
        return 1 if len(labels) > 1 and labels[-1].isalpha() and not any(x[0] == "-" or x[-1] == "-" for x in labels) else -1
    if kind == "ip":
        return 1 if _address(found) else -1
    if kind == "card":
        return 1 if (_iban(found) if form == "account" else luhn(digits)) else -1
    if form == "base":
        return 1 if digits[0] != "0" else -1
    if form in ("north", "loose"):
        return (1 if digits[0] > "1" and digits[3] > "1" else -1) if len(digits) == 10 else 0
    if form == "exit":
        return 1 if 10 <= len(digits) - 2 <= 13 else -1
    return 1 if len(set(digits)) > 2 else -1


def _gazetteer(kind: str, form: str, found: str, digits: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[.\s)\]}]+", found.lower())[-1] in _TLDS else -1
    if kind == "ip":
        return -1 if found.lower().startswith(_RESERVED) else 1
    if kind == "card":
        return 1 if (found[:2] in _COUNTRIES if form == "account" else digits.startswith(_ISSUERS)) else -1
    if found[0] == "+" or form == "exit":
        return 1 if digits.lstrip("0").startswith(_CALLING) else -1
    return -1 if digits[:2] in ("19", "20") and form == "loose" else 0


def _cues(kind: str, text: str, start: int, end: int) -> int:
    """Do words beside the candidate, in its line, name the kind?"""
    before = text[max(0, start - WINDOW) : start].rpartition("\n")[2].lower()
    after = text[end : end + AFTER].partition("\n")[0].lower()
    return int(any(re.search(rf"(?<![^\W\d_]){re.escape(cue)}", side) for cue in _CUES[kind] for side in (before, after)))


def _surroundings(text: str, start: int, end: int) -> int:
    """-1 if glued to a name, a sign of equality or a quotation mark (a key, a version or a hash), or announced as another thing."""
    before = text[max(0, start - WINDOW) : start].rpartition("\n")[2].lower()
    if before[-1:] and before[-1:] in "=\"'_#/\\v" or text[end : end + 1] in ("=", "_", '"'):
        return -1
    last = before[-18:]
    return -1 if any(re.search(rf"(?<![^\W\d_]){word}", last) for word in _OTHER_THINGS) else 0


def _wider(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, form) of what the generators propose."""
    if _SPOKEN_SIGN.search(text):
        yield from ((m.start(), m.end(), "email", "spoken") for m in _SPOKEN.finditer(text))
    if not _DIGIT.search(text):
        return
    if ":" in text:
        yield from ((m.start(), m.end(), "ip", "v6") for m in _V6.finditer(text) if m.end() - m.start() > 3 and _DIGIT.search(m[0]))
    yield from ((m.start(), m.end(), "ip", "v4") for m in _V4.finditer(text))
    for m in _CARD.finditer(text):
        free = text[m.start() - 1 : m.start()] + text[m.end() : m.end() + 1]  # not part of a word, key or hash
        if 14 <= m.end() - m.start() <= 37 and 14 <= len(_NOT_DIGIT.sub("", m[0])) <= 19 and not re.search(r"[\w=\"'/]", free):
            yield m.start(), m.end(), "card", "run"
    yield from ((m.start(), m.end(), "card", "account") for m in _ACCOUNT.finditer(text))
    yield from ((m.start(), m.end(), "card", "card") for m in _CARD_OTHER.finditer(text))
    yield from ((m.start(), m.end(), "phone", m.lastgroup) for m in _NATIONAL.finditer(text))


def candidates(text: str) -> list[Candidate]:
    """All candidates of a text, base spans first."""
    base = base_spans(text)
    starts, reach = [s[0] for s in base], list(accumulate((s[1] for s in base), max))
    out = []
    for a, b, kind, form in chain(((a, b, k, "base") for a, b, k in base), _wider(text)):
        before = 0 if form == "base" else bisect_left(starts, b)
        if before and reach[before - 1] > a:
            continue  # what a base span has is not proposed again
        found = text[a:b]
        digits = _NOT_DIGIT.sub("", found)
        votes = (_form(kind, form, found, digits), _gazetteer(kind, form, found, digits), _cues(kind, text, a, b), _surroundings(text, a, b))
        edge = int((a == 0 or not text[a - 1].isalnum()) and (b == len(text) or not text[b].isalnum()))
        out.append(Candidate(a, b, kind, form == "base", votes, (edge, FORMS.index(form), min(len(digits), 20) // 4)))
    return out


@dataclass
class Model:
    """reliability: per kind, P(vote | latent class) as [class][labeler][vote + 1]; prior: per kind, P(personal data)."""

    prior: dict[str, float] = field(default_factory=dict)
    reliability: dict[str, np.ndarray] = field(default_factory=dict)
    weights: np.ndarray | None = None

    def probability(self, c: Candidate) -> float:
        return float(1 / (1 + np.exp(-_encode(c.kind, c.votes, c.features) @ self.weights)))


def _encode(kind: str, votes, features) -> np.ndarray:
    one = [1.0] + [float(kind == k) for k in KINDS]
    for v in votes:
        one += [float(v == 1), float(v == -1)]
    return np.array([*one, float(features[0]), *(float(features[1] == f) for f in range(1, len(FORMS))), float(features[2])])


def fit(counts: list[tuple], rounds: int = 50) -> Model:
    """A model from rows (kind, votes, features, n): EM for the reliabilities, then the span classifier."""
    model, x, y, w = Model(), [], [], []
    for kind in KINDS:
        own = sorted((tuple(r[1]), tuple(r[2]), r[3]) for r in counts if r[0] == kind)
        if not own:
            continue
        votes = np.array([r[0] for r in own]) + 1
        n = np.array([r[2] for r in own], dtype=float)
        # Labelers start out as better than chance, the form labeler most; a prior count of each keeps rare kinds near that.
        belief = np.array([[[0.25, 0.35, 0.4], [0.5, 0.35, 0.15]]] * 4)  # [labeler][class 1, class 0] by vote -1, 0, 1
        belief[0] = (0.1, 0.2, 0.7), (0.75, 0.15, 0.1)
        belief[2] = (0.01, 0.49, 0.5), (0.01, 0.94, 0.05)  # cues: absent from most candidates
        belief[3] = (0.05, 0.94, 0.01), (0.5, 0.49, 0.01)
        start = belief[:, ::-1].transpose(1, 0, 2)  # [class][labeler][vote]
        rel, prior = start.copy(), 0.5
        for _ in range(rounds):
            like = np.stack([np.prod([rel[c, j, votes[:, j]] for j in range(4)], axis=0) for c in (0, 1)])
            like *= np.array([[1 - prior], [prior]])
            post = like[1] / like.sum(0)
            prior = float((n @ post + 1) / (n.sum() + 2))
            for c, p in ((0, 1 - post), (1, post)):
                for j, v in product(range(4), range(3)):
                    rel[c, j, v] = (n * p) @ (votes[:, j] == v) + 20 * start[c, j, v]
                rel[c] /= rel[c].sum(axis=1, keepdims=True)
        model.prior[kind], model.reliability[kind] = prior, rel
        x += [_encode(kind, r[0], r[1]) for r in own]
        y += list(post)
        w += list(np.log1p(n))  # so that rare patterns count too
    width = len(_encode("email", (0, 0, 0, 0), (0, 0, 0)))
    model.weights = np.zeros(width)
    if x:
        x, y, w = np.array(x), np.array(y), np.array(w)
        for _ in range(30):  # Newton's method with a ridge
            p = 1 / (1 + np.exp(-x @ model.weights))
            hessian = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(width)
            model.weights = model.weights + np.linalg.solve(hessian, x.T @ (w * (y - p)) - 1e-3 * model.weights)
    return model


def vote_counts(docs: DataFrame) -> DataFrame:
    """Counts of all candidates of all documents by (kind, votes, features)."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple, int] = {}
        for batch in batches:
            for text in batch["text"]:
                for c in candidates(text or ""):
                    key = (c.kind, c.votes, c.features)
                    seen[key] = seen.get(key, 0) + 1
        yield pd.DataFrame([(k, list(v), list(f), n) for (k, v, f), n in seen.items()], columns=["kind", "votes", "features", "n"])

    each = docs.select("text").mapInPandas(of, "kind string, votes array<int>, features array<int>, n long")
    return each.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n"))


def fit_corpus(docs: DataFrame) -> Model:
    """The model of a corpus.  What comes to the driver is bounded by the number of kinds, votes and features: some thousands of rows."""
    return fit([tuple(r) for r in vote_counts(docs).collect()])


def detect(text: str | None, model: Model, threshold: float = THRESHOLD) -> tuple[list, list]:
    """(base spans, all spans) of a text, each by start, then kind as listed."""
    found = candidates(text or "")
    order = lambda s: (s[0], KINDS.index(s[2]))
    base = sorted(((c.start, c.end, c.kind) for c in found if c.base), key=order)
    added, done = [], 0
    for c in sorted((c for c in found if not c.base), key=lambda c: (c.start, KINDS.index(c.kind))):
        if c.start >= done and model.probability(c) >= threshold:
            added.append((c.start, c.end, c.kind))
            done = c.end
    return base, sorted(base + added, key=order)


def written(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256 and spans of every document."""
    model = fit_corpus(docs)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, spans = detect(text, model, threshold)
            kinds = [k for _, _, k in base]
            rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
        return pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select("doc_id", of(F.col("text")).alias("found")).select(F.col("doc_id").cast("long").alias("doc_id"), "found.*")


def mask(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in angle brackets.

    Where spans of different kinds overlap, their union is replaced once, by the first kind.
    A column n_chars is brought up to date; null texts stay null.
    """
    model = fit_corpus(docs)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        def of(text):
            if text is None:
                return None
            out, done, last = [], 0, None
            for a, b, kind in detect(text, model, threshold)[1]:
                if a >= done or last is None:
                    out += [text[done:a], f"<{kind}>"]
                done, last = max(done, b), kind
            return "".join(out) + text[done:]

        return pd.Series([of(x) for x in texts], dtype=object)

    done = docs.withColumn("text", masked(F.col("text")))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*(F.col(f"`{c}`") for c in docs.columns))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find_personal_data(common.read_table(spark, sf_dir, "documents"))
