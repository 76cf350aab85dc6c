"""Secret scans: patterns for known shapes and a randomness test battery for the rest.

Candidates are long runs of encoding characters. For each the alphabet is
inferred (the smallest of ALPHABETS that holds the run) and three tests measure
the run against a uniformly random string of it: chi-squared uniformity of the
alphabet, Wald-Wolfowitz runs above and below the alphabet's middle, and the
serial correlation of neighbours. Fisher's method combines them into one
p-value, weighted by length: a run that is short for its alphabet gives the
tests little power, so less evidence rejects it. Benjamini-Hochberg over all
candidates of the corpus finds the runs that are surely no random strings;
the others are reported as ``random`` spans.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.llm.common import stored, sub_batches

# The base patterns. ASCII case folding only.
ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ["assign", "access", "hex", "random"]
LEAST = {"assign": 6, "access": 20, "hex": 24}
HEX_LONG = re.compile(r"[0-9a-f]{24,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
MIN_RANDOM = 20
SEPARATORS = "+/-_"  # encoding characters that also join words, paths and prefixes
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = [("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"), ("lower", LOWER), ("upper", UPPER),
             ("base32", UPPER + "234567"), ("base32 lower", LOWER + "234567"), ("lower36", DIGITS + LOWER),
             ("upper36", DIGITS + UPPER), ("letters", UPPER + LOWER),
             ("base58", "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"), ("alnum", DIGITS + UPPER + LOWER),
             ("base64", UPPER + LOWER + DIGITS + "+/"), ("url64", UPPER + LOWER + DIGITS + "-_")]
# Letter counts in 10,000 letters of running text (a to z), for the test of common letters.
COMMON = dict(zip(LOWER, (820, 150, 280, 430, 1270, 220, 200, 610, 700, 15, 77, 400, 240, 670, 750, 190, 10, 600, 630, 910,
                          280, 98, 240, 15, 200, 7)))
FDR = 0.05
# Fixed number of p-value cells: the corpus-wide ranking needs only their counts.
CELLS = 4096
LOG_FLOOR = 60.0  # p-values below e^-60 share the first cell


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds: leftmost non-overlapping matches per kind,
    those that are too short dropped (they still consume their text)."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # maximal runs of at least 24: the same as all maximal runs with the short ones dropped
    out += [(m.start(), m.end(), "hex") for m in HEX_LONG.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# ------------------------------------------------------------------ test battery

def _chi2_tail(x: float, k: int) -> float:
    """Upper tail of the chi-squared distribution (Wilson-Hilferty)."""
    if x <= 0:
        return 1.0
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def infer_alphabet(run: str) -> tuple[str, str] | None:
    """The smallest alphabet that holds all characters (padding aside)."""
    used = set(run.rstrip("="))
    return next(((n, a) for n, a in ALPHABETS if used <= set(a)), None)


def _common_letters(body: str, alphabet: str) -> float:
    """Odds that uniformly random letters of the alphabet are as common in running text as these."""
    table = [math.log(COMMON[c.lower()]) for c in alphabet if c.isalpha()]
    mean = sum(table) / len(table)
    var = sum((x - mean) ** 2 for x in table) / len(table)
    own = [math.log(COMMON[c.lower()]) for c in body if c.isalpha()]
    return 0.5 * math.erfc((sum(own) - len(own) * mean) / math.sqrt(2 * var * len(own))) if own else 1.0


def randomness(run: str) -> tuple[float, float]:
    """(p, power): the combined p-value of the battery under "uniformly random", and how far the
    length lets the tests tell text from random strings (0 to 1).

    Beside the three tests the count of equal pairs (uniformity where cells are few) and
    the odds of missing a whole class of characters enter the combination; where the alphabet
    has most letters, also the share of letters common in running text and the shares of
    digits, lower-case and upper-case letters.
    """
    body = run.rstrip("=")
    n = len(body)
    inferred = infer_alphabet(run)
    if inferred is None or n < MIN_RANDOM:
        return 0.0, 0.0
    name, alphabet = inferred
    k = len(alphabet)
    x = np.array([alphabet.index(c) for c in body])
    counts = np.bincount(x, minlength=k)
    # uniformity over as many equal cells as the length supports (five expected in each)
    cells = max(2, min(k, n // 5))
    grouped = np.bincount(x * cells // k, minlength=cells)
    expected = np.bincount(np.arange(k) * cells // k, minlength=cells) * n / k
    p_cells = _chi2_tail(float(((grouped - expected) ** 2 / expected).sum()), cells - 1)
    # and of the repeats: pairs of equal characters against their expectation
    pairs, mean = float((counts * (counts - 1)).sum() / 2), n * (n - 1) / 2 / k
    p_pairs = _two_sided((pairs - mean) / math.sqrt(mean * (1 - 1 / k)))
    high = x >= k / 2
    a, b = int(high.sum()), int((~high).sum())
    if a and b:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        m = 2 * a * b / n + 1
        v = (m - 1) * (m - 2) / (n - 1)
        p_runs = _two_sided((runs - m) / math.sqrt(v)) if v > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    c = x - x.mean()
    p_serial = _two_sided(float((c[1:] * c[:-1]).sum() / max((c * c).sum(), 1e-12)) * math.sqrt(n))
    # classes of characters that a random string of the alphabet would surely show
    digits = sum(ch.isdigit() for ch in alphabet)
    lower = sum(ch.islower() for ch in alphabet)
    upper = sum(ch.isupper() for ch in alphabet)
    p_class = 1.0
    for size, seen in ((digits, any(ch.isdigit() for ch in body)), (lower, any(ch.islower() for ch in body)),
                       (upper, any(ch.isupper() for ch in body))):
        if size and not seen:
            p_class *= (1 - size / k) ** n
    ps = [max(p, 1e-300) for p in (p_cells, p_pairs, p_runs, p_serial, p_class)]
    if lower + upper >= 20:
        ps.append(max(_common_letters(body, alphabet), 1e-300))
        sizes = [(sum(map(test, alphabet)), sum(map(test, body))) for test in (str.isdigit, str.islower, str.isupper)]
        sizes = [(size, seen) for size, seen in sizes if size]
        if len(sizes) > 1:
            each = sum(seen for _, seen in sizes) / sum(size for size, _ in sizes)
            ps.append(max(_chi2_tail(sum((seen - size * each) ** 2 / (size * each) for size, seen in sizes),
                                     len(sizes) - 1), 1e-300) if each else 1e-300)
    fisher = -2 * sum(math.log(p) for p in ps)
    power = min(1.0, n / (2.0 * k))
    return _chi2_tail(fisher, 2 * len(ps)), power


def level_cell(p: float, power: float) -> int:
    """Cell of a length-weighted p-value: p / w with weight w = 1 / (0.5 + power), so that a
    short run is rejected sooner. Cells are equal in log p."""
    weighted = min(1.0, p * (0.5 + power))
    log = max(-LOG_FLOOR, math.log(max(weighted, 1e-300)))
    return min(CELLS - 1, int((log + LOG_FLOOR) / LOG_FLOOR * CELLS))


def cell_level(cell: int) -> float:
    """Largest p-value of a cell."""
    return math.exp((cell + 1) / CELLS * LOG_FLOOR - LOG_FLOOR)


def rejected_below(counts: dict[int, int], fdr: float = FDR) -> int:
    """Benjamini-Hochberg over cell counts: cells up to the returned one are rejected (-1: none)."""
    m, seen, out = sum(counts.values()), 0, -1
    for cell in sorted(counts):
        seen += counts[cell]
        if cell_level(cell) <= fdr * seen / m:
            out = cell
    return out


def pieces(run: str) -> list[tuple[int, int]]:
    """(start, end) of the parts of a run to test, longer ones first at a place: the run itself and its
    parts between any kinds of the separators in it, as far as one alphabet holds them and
    they have at least MIN_RANDOM characters."""
    has = [c for c in SEPARATORS if c in run]
    found = set()
    for kinds in range(1 << len(has)):
        cut = "".join(c for i, c in enumerate(has) if kinds >> i & 1)
        for m in re.finditer(f"[^{re.escape(cut)}]+" if cut else ".+", run):
            if len(m.group().rstrip("=")) >= MIN_RANDOM and infer_alphabet(m.group()):
                found.add(m.span())
    return sorted(found, key=lambda s: (s[0], -s[1]))


def random_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, cell, around) of the pieces of all candidates of a text; ``around`` is the highest
    cell of the pieces that hold this one and more (-1: none)."""
    out = []
    for m in CANDIDATE.finditer(text):
        open_: list[tuple[int, int]] = []  # (end, cell) of the pieces that reach beyond this start, at most one per cut
        for s, e in pieces(m.group()):
            open_ = [o for o in open_ if o[0] > s]
            around = max((c for end, c in open_ if end >= e), default=-1)
            cell = level_cell(*randomness(m.group()[s:e]))
            open_.append((e, cell))
            out.append((m.start() + s, m.start() + e, cell, around))
    return out


# ------------------------------------------------------------------ Spark

def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("cell", pa.int32()),
                              ("around", pa.int32())]))
    for whole in batches:
        for b in sub_batches(whole, "_text"):
            spans = []
            for text in b.column("_text").to_pylist():
                text = text or ""
                spans.append([{"start": s, "end": e, "kind": k, "cell": -1, "around": -1} for s, e, k in base_spans(text)]
                             + [{"start": s, "end": e, "kind": "random", "cell": c, "around": a}
                                for s, e, c, a in random_spans(text)])
            yield pa.record_batch([b.column("_id"), pa.array(spans, kinds)], names=["_id", "found"])


def secret_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per row of ``docs``: id and ``found``, its spans (start, end, kind) by start, then
    kind (assign, access, hex, random), in code points, end exclusive.

    Base kinds come from their patterns and always stay. ``random`` are candidates that
    the battery does not reject at the corpus-wide false-discovery rate ``fdr``, and of
    a kept piece of a candidate no part is reported again;
    the ranking behind it counts the p-values of all candidates of all documents
    in a fixed number of cells (at most CELLS rows reach the driver). Null and
    empty texts have no spans; repeated rows are scanned and counted each.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    t = src.schema["_id"].dataType.simpleString()
    found = stored(src.mapInArrow(_scan, f"_id {t}, found array<struct<start:int,end:int,kind:string,cell:int,around:int>>"),
                   "secret-spans")
    counts = (found.select(F.explode("found").alias("s")).where("s.kind = 'random'").groupBy("s.cell").count()
              .collect())
    last = rejected_below({r[0]: r[1] for r in counts}, fdr)
    order = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter("found", lambda s: (s["kind"] != "random") | ((s["cell"] > last) & (s["around"] <= last)))
    ranked = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("o"),
                                                  s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.transform(F.array_sort(ranked), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                 s["kind"].alias("kind")))
    return found.select(F.col("_id").alias(id_col), spans.alias("found"))


def secret_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """Digest of ``secret_spans`` per document: counts of the base kinds, sha256 of the base
    spans and all spans as kind:start:end, comma-joined (empty string: none)."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = secret_spans(docs, id_col=id_col, text_col=text_col, fdr=fdr)
    def number(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    n = {k: number(k) for k in KINDS}
    base = F.filter("found", lambda s: s["kind"] != "random")
    return found.select(F.col(id_col), n["assign"], n["access"], n["hex"], n["random"],
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


__all__ = ["base_spans", "randomness", "rejected_below", "secret_spans", "secret_report"]
