"""Secret scan: fixed patterns plus a battery of randomness tests with false-discovery control."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import materialize

# The patterns of the base kinds and the least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "random")

#: What the battery tests: runs of characters that encoded keys are made of.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}")
# Alphabets in the order in which an encoding is inferred.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = (
    ("hex", _DIGITS + "abcdef"),
    ("HEX", _DIGITS + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("lower", _LOWER),
    ("base36", _DIGITS + _LOWER),
    ("BASE36", _DIGITS + _UPPER),
    ("letters", _UPPER + _LOWER),
    ("base62", _DIGITS + _UPPER + _LOWER),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
    ("any", _UPPER + _LOWER + _DIGITS + "+/-_"),
)
_SETS = [(frozenset(a), {c: i for i, c in enumerate(a)}) for _, a in ALPHABETS]

#: A key passes the battery unless random characters would look worse this rarely.
MIN_RANDOMNESS = 1e-3
#: Share of false discoveries among the reported spans of a length class.
FDR = 0.01
#: Ordinary text: chance that two of its letters are equal, and that the
#: character class changes from one character to the next.
TEXT_COLLISION, TEXT_CHANGE = 0.065, 0.10
#: Length classes in which false discoveries are controlled, by their least length.
LENGTH_CLASSES = (16, 24, 32, 48, 96)
#: -log10 p is counted in steps of 1/BINS up to MAX_LOG.
BINS, MAX_LOG = 20, 60

SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
          "base array<struct<start:long,kind:int,end:long>>, "
          "tested array<struct<start:long,end:long,length_class:int,bin:int,random:boolean>>")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_square_tail(x: float, df: float) -> float:
    """P(chi-square with ``df`` degrees of freedom >= x), by the cube-root normal approximation."""
    if x <= 0:
        return 1.0
    return _upper_normal(((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def _binomial_tail(n: int, p: float, k: int) -> float:
    """P(Binomial(n, p) >= k)."""
    if k <= 0:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
            + (n - i) * math.log1p(-p) for i in range(k, n + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def _class(char: str) -> int:
    return 0 if char.isdigit() else 1 if char.islower() else 2 if char.isupper() else 3


def battery(token: str) -> tuple[float, float] | None:
    """(p_random, p_text) of a token, or None if no encoding holds it.

    p_random is small if characters drawn evenly from the inferred alphabet
    would rarely look so uneven: chi-squared uniformity, runs about the
    alphabet's middle and lag-1 serial correlation, combined by Fisher's
    method.  p_text is small if ordinary text of this length would rarely
    look so random: too even a spread for the letter frequencies of text, and
    more changes of character class than words have.  Plain numbers and
    tokens without a letter are not tested.
    """
    chars = frozenset(token)
    code = next((c for s, c in _SETS if chars <= s), None)
    if code is None or not any(c.isalpha() for c in chars):
        return None
    n, k = len(token), len(code)
    x = np.fromiter((code[c] for c in token), dtype=np.float64, count=n)
    counts = np.bincount(x.astype(np.int64), minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    # the statistic's variance on n draws is below that of a chi-square
    scaled = (k - 1) + (chi - (k - 1)) * math.sqrt(n / (n - 1))
    p_chi = chi_square_tail(scaled, k - 1)

    high = x >= k / 2
    a = int(high.sum())
    b, runs = n - a, 1 + int((high[1:] != high[:-1]).sum())
    p_runs = 1.0
    if a and b:
        mean = 2 * a * b / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * _upper_normal(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    elif n > 16:
        p_runs = 2.0 ** (1 - n)

    centred = x - x.mean()
    spread = float((centred ** 2).sum())
    p_serial = 2.0 ** (1 - n)
    if spread > 0:
        r = float((centred[1:] * centred[:-1]).sum()) / spread
        p_serial = 2 * _upper_normal(abs(r + 1 / n) * math.sqrt(n))
    fisher = -2 * sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    half = fisher / 2
    p_random = math.exp(-half) * (1 + half + half * half / 2)  # chi-square tail, 6 degrees of freedom

    # an ordinary token has the text's collisions whatever alphabet it falls in
    excess = max(0.0, n * (k * TEXT_COLLISION - 1))
    p_even = _upper_normal(-(chi - (k - 1 + excess)) / math.sqrt(2 * (k - 1 + 2 * excess)))
    changes = sum(_class(p) != _class(q) for p, q in zip(token, token[1:], strict=False))
    p_change = _binomial_tail(n - 1, TEXT_CHANGE, changes)
    both = max(p_even * p_change, 1e-300)
    return p_random, min(1.0, both * (1 - math.log(both)))  # chi-square tail, 4 degrees of freedom


def controlled(p_random: float, p_text: float) -> float:
    """The p-value whose false discoveries are controlled: that as ordinary
    text over that as random characters, and 1 for a token that the battery
    refuses.  Never below the former, so text is reported no more often than
    the rate says; tokens that are neither text nor quite random need more."""
    return min(1.0, p_text / p_random) if p_random >= MIN_RANDOMNESS else 1.0


def tested_spans(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int, bool]]:
    """(start, end, length class, bin, random) of the tokens outside base spans that the battery can test.

    The bin is -log10 of the controlled p-value, see ``controlled``.  Both lists are in order, so
    the base spans are walked once, with the furthest end so far.
    """
    at, covered = 0, -1
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(base) and base[at][0] <= start:
            covered = max(covered, base[at][2])
            at += 1
        if end <= covered:
            continue
        if (found := battery(m.group())) is not None:
            random = found[0] >= MIN_RANDOMNESS
            p = controlled(*found)
            yield (start, end, max(x for x in LENGTH_CLASSES if x <= end - start),
                   int(min(-math.log10(max(p, 1e-300)), MAX_LOG) * BINS), random)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        ("base", pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))),
        ("tested", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("length_class", pa.int32()),
                                       ("bin", pa.int32()), ("random", pa.bool_())])))])
    names = [f.name for f in schema.field("tested").type.value_type]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            base = base_spans(text)
            joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base)
            kinds = [k for _, k, _ in base]
            rows.append({
                "doc_id": doc_id, "n_assign": kinds.count(0), "n_access": kinds.count(1), "n_hex": kinds.count(2),
                "base_sha256": hashlib.sha256(joined.encode()).hexdigest(),
                "base": [{"start": s, "kind": k, "end": e} for s, k, e in base],
                "tested": [dict(zip(names, t, strict=True)) for t in tested_spans(text, base)]})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def thresholds(tested: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Least bin that is reported, by length class: Benjamini-Hochberg over
    the histogram of all tested tokens of that class.

    A token that the battery refuses has p-value 1: it counts among the tests,
    never among the discoveries.  So what is counted above a bin is what is
    reported from it, and for ordinary text the controlled p-value is at least
    the one as text, which keeps the rate.
    """
    counts: dict[int, dict[int, int]] = {}
    for r in tested.groupBy("length_class", "bin").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r["length_class"], {})[r["bin"]] = r["n"]
    least = {}
    for length, bins in counts.items():
        total, above = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            above += bins[b]
            if 10 ** (-b / BINS) <= fdr * above / total:
                least[length] = b
    return least


def _scanned(documents: DataFrame) -> DataFrame:
    return materialize(documents.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_scan, SCHEMA), "secrets")


def secret_spans(documents: DataFrame, fdr: float = FDR) -> DataFrame:
    """Secrets of every document: counts and digest of the base spans, and all spans.

    Base kinds match fixed patterns.  Every other run of 16 or more key
    characters is tested: it is reported as ``random`` if the battery accepts
    it as random and its p-value (``controlled``: as text, over as random) is
    among the discoveries of its length class at false-discovery rate ``fdr``,
    counted over all documents.  Only histogram counts (at most classes x bins rows) reach the
    driver.  The text is read once.  Null and empty texts have no spans (the
    digest of the empty string); null doc_ids stay null; repeated rows are
    scanned one by one and weigh as often; extra columns are ignored; an
    empty table gives an empty result.  ``all_spans`` holds the spans as
    (start, kind, end), kinds by their place in ``KINDS``.
    """
    scanned = _scanned(documents)
    least = thresholds(scanned.select(F.explode("tested").alias("t")).select("t.*"), fdr)
    limits = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair] or [F.lit(0), F.lit(0)])
    never = F.lit(MAX_LOG * BINS + 1)
    found = F.filter("tested", lambda t: t["random"]
                     & (t["bin"] >= F.coalesce(F.element_at(limits, t["length_class"]), never)))
    added = F.transform(found, lambda t: F.struct(
        t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.array_sort(F.concat("base", added))
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                          spans.alias("all_spans"), F.size(found).cast("long").alias("n_random")).withColumn(
        "spans", F.array_join(F.transform("all_spans", lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","))


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """``text`` with each of the (start, end) spans, or run of overlapping ones, replaced."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(documents: DataFrame, mask: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """``documents`` with every secret of its texts replaced by ``mask``.

    A first pass over the texts counts p-values for the thresholds; a second
    one scans them again and masks, so no text crosses the network and rows
    need no key.  n_chars, where there is such a column, follows the new text.
    """
    least = thresholds(_scanned(documents).select(F.explode("tested").alias("t")).select("t.*"), fdr)
    at = documents.columns.index("text")
    size = documents.columns.index("n_chars") if "n_chars" in documents.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            sizes = batch.column(size).to_pylist() if size is not None else []
            for i, text in enumerate(texts):
                if not text:
                    continue
                base = base_spans(text)
                spans = [(s, e) for s, _, e in base] + [
                    (s, e) for s, e, length, b, random in tested_spans(text, base)
                    if random and b >= least.get(length, MAX_LOG * BINS + 1)]
                if spans:
                    texts[i] = masked(text, spans, mask)
                    if sizes:
                        sizes[i] = len(texts[i])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, type=columns[at].type)
            if size is not None:
                columns[size] = pa.array(sizes, type=columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return documents.mapInArrow(run, documents.schema)
