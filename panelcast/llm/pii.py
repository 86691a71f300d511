"""Personal data: base patterns, and contextual extraction bootstrapped from
them.

Base entities are seeds.  The two words before a seed form a lexical pattern;
other identifier-shaped tokens after the same words are instances of it.
Spark scores the graph of patterns and instances in rounds (a pattern by the
mean score of its distinct instances, an instance by the patterns it is found
with).  Instances that a pattern of high confidence finds are seeds of the next
round, and tokens found by such patterns in the end are reported as ``id``.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import bundled, durable, map_rows, quoted, texts, unbundled

KINDS = ("email", "ip", "card", "phone", "id")
ROUNDS = 3
MIN_SEEDS = 3            # distinct seed instances that a pattern needs
MIN_PATTERN = 0.8        # confidence of patterns that extract
SEED_PATTERN = 0.8       # confidence of patterns whose instances become seeds
MIN_LENGTH = 6           # characters of an identifier-shaped token
MAX_LENGTH = 200         # ... and the most; longer runs are cut at all marks

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:(\.[0-9]+)(\.[0-9]+)(\.[0-9]+))?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]")
_TOKEN = re.compile(r"\S+")
_EDGES = "\"'`.,;:!?()[]{}<>|*#&%$"
_PIECE = re.compile(f"[^{re.escape(_EDGES)}=/\x80-\U0010ffff]+")      # also of scripts without blanks
_LETTERS = re.compile(r"\w+")


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _ips(text: str):
    # A run of digits that begins no address can't hold the start of one.
    for m in _IP.finditer(text):
        if m.group(1) and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = _DIGITS.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, ordered; per kind leftmost and
    not overlapping, in time linear in the text."""
    found = [(s, k, e) for k, rule in enumerate((_emails, _ips, _cards, _phones)) for s, e in rule(text)]
    return sorted(found)


def _tokens(text: str, s: int, e: int):
    """(start, end) of what may be identifiers in a run without white space:
    the part after the last '=' without the marks around it and, if the run is
    long, also the ASCII pieces between marks of all that is not in that part."""
    token = text[s:e].rstrip(_EDGES + "=")
    cut = token.rfind("=") + 1
    tail = token[cut:].lstrip(_EDGES)
    at = s + len(token) - len(tail)
    whole = len(tail) <= MAX_LENGTH
    if e - s > MAX_LENGTH:
        for m in _PIECE.finditer(text, s, at if whole else s + len(token)):
            if m.end() - m.start() <= MAX_LENGTH:
                yield m.span()
    if whole:
        yield at, at + len(tail)


def _word(text: str, s: int, e: int, end: int) -> str:
    """The context word of the run (s, e) up to ``end``; of a long run, the
    letters and digits after its last mark."""
    w = text[max(s, end - MAX_LENGTH):end].lower()
    if e - s > MAX_LENGTH:
        return ([""] + _LETTERS.findall(w))[-1]
    return w.strip(_EDGES)


def _mentions(text: str, spans: list[tuple[int, int, int]]) -> list[tuple]:
    """(pattern, instance hash, kind or -1, start, end) of the base spans and
    of identifier-shaped tokens beside them."""
    if not re.search("[0-9]", text) and not spans:
        return []
    taken, out = [], []
    for s, k, e in spans:
        taken.append((s, e))
        out.append((s, e, k))
    taken.sort()
    i = 0
    runs = [m.span() for m in _TOKEN.finditer(text)]
    for run in runs:
        if run[1] - run[0] < MIN_LENGTH:
            continue
        for s, e in _tokens(text, *run):
            if e - s < MIN_LENGTH or sum(map(str.isdigit, text[s:e])) < 2:
                continue
            while i < len(taken) and taken[i][1] <= s:
                i += 1
            if not any(a < e and s < b for a, b in taken[i:i + 4]):
                out.append((s, e, -1))
    rows = []
    starts = [a for a, _ in runs]
    for s, e, k in out:
        j = bisect_left(starts, s)                           # runs that begin before
        before = [_word(text, a, b, min(b, s)) for a, b in runs[max(0, j - 2):j]]
        if len(before) == 2 and all(before):
            rows.append((" ".join(before), xxhash.xxh64_intdigest(text[s:e].lower()) - (1 << 63), k, s, e))
    return rows


def analyse(docs: DataFrame) -> DataFrame:
    """``docs`` with _rid, _base (spans) and _mentions of the column text."""
    extra = docs.columns
    d = docs.withColumn("_rid", F.monotonically_increasing_id())
    added = docs.sparkSession.createDataFrame([], "_base array<struct<s:int,k:int,e:int>>, "
                                              "_mentions array<struct<p:string,i:bigint,k:int,s:int,e:int>>").schema
    schema = StructType(d.schema.fields + added.fields)

    def run(b):
        base, near = [], []
        for t in texts(b):
            found = base_spans(t)
            base.append([dict(zip("ske", x, strict=True)) for x in found])
            near.append([dict(zip("pikse", x, strict=True)) for x in _mentions(t, found)])
        return {**{c: b.column(c) for c in extra}, "_rid": b.column("_rid"), "_base": base, "_mentions": near}

    return map_rows(d, schema, run)


def score_patterns(mentions: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
                   seed_pattern: float = SEED_PATTERN) -> DataFrame:
    """(p, conf) of patterns with at least ``min_seeds`` distinct seeds, from
    mention rows (p, i, k).  Seeds are the base entities and, from the second
    round on, the instances that a pattern of confidence ``seed_pattern``
    found; many weak patterns make no seed, or any common number would become
    one.  Every edge of the graph counts once, however many copies of a
    document hold it."""
    edges = durable(mentions.groupBy("p", "i").agg((F.max("k") >= 0).alias("base")), "pii-edges")
    score = edges.groupBy("i").agg(F.max("base").alias("seed")).withColumn("s", F.col("seed").cast("double"))
    for r in range(rounds):
        pattern = (edges.join(score, "i").groupBy("p")
                   .agg((F.sum("s") / (F.count("*") + 0.5)).alias("conf"), F.count_if("seed").alias("seeds"))
                   .where(F.col("seeds") >= min_seeds).select("p", "conf"))
        pattern = durable(pattern, "pii-patterns")
        if r == rounds - 1:
            return pattern
        # Noisy or over the patterns; a base entity stays certain.
        reach = edges.join(pattern, "p", "left").groupBy("i").agg(
            F.max("base").alias("base"), F.coalesce(F.max("conf"), F.lit(0.0)).alias("best"),
            F.sum(F.log(F.greatest(F.lit(1e-6), 1 - F.coalesce("conf", F.lit(0.0))))).alias("l"))
        score = reach.select("i", (F.col("base") | (F.col("best") >= seed_pattern)).alias("seed"),
                             F.when(F.col("base"), 1.0).otherwise(1 - F.exp("l")).alias("s"))
    return pattern


def extract(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with _base and _spans: (start, kind, end) structs of the base
    entities and of all entities.  Null texts hold none; repeated rows give
    repeated rows and count once as evidence.  Columns of any name may stand
    beside the text; those named _base and _spans are replaced.  An
    identifier-shaped token has 6 to 200 characters, two digits among them."""
    kept = [c for c in docs.columns if c not in ("_base", "_spans")]
    out = _extract(bundled(docs.select(*map(quoted, kept)), "text"), **options)
    return out.select(*[F.col(c) if c == "text" else F.col("_rest")[c].alias(c) for c in kept], "_base", "_spans")


def _extract(docs: DataFrame, min_pattern: float = MIN_PATTERN, min_seeds: int = MIN_SEEDS,
             rounds: int = ROUNDS) -> DataFrame:
    d = durable(analyse(docs), "pii")
    m = d.select("_rid", F.explode("_mentions").alias("m")).select("_rid", "m.*")
    high = score_patterns(m.select("p", "i", "k"), rounds, min_seeds).where(F.col("conf") >= min_pattern)
    new = (m.where("k < 0").join(high, "p").groupBy("_rid").agg(F.collect_set(
        F.struct("s", F.lit(KINDS.index("id")).alias("k"), "e")).alias("_new")))
    d = d.join(new, "_rid", "left")
    every = F.when(F.col("_new").isNull(), F.col("_base")).otherwise(F.sort_array(F.concat("_base", "_new")))
    return d.select(*docs.columns, "_base", every.alias("_spans"))


def _listed(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)."""
    d = extract(docs.select("doc_id", "text"), **options)

    def count(k):
        # One parameter only: a second one would be the element's index.
        return F.size(F.filter("_base", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = [count(k) for k in range(4)]
    return d.select("doc_id", *counts, F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
                    _listed(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in brackets;
    overlapping spans become one.  Columns of any name may stand beside the text."""
    own = bundled(docs, "text")
    d, columns = _extract(own, **options), own.columns

    def run(b):
        out = []
        for t, spans in zip(b.column("text").to_pylist(), b.column("_spans").to_pylist(), strict=True):
            if spans:
                parts, at = [], 0
                for x in spans:
                    if x["s"] >= at:
                        parts += [t[at:x["s"]], f"[{KINDS[x['k']].upper()}]"]
                    at = max(at, x["e"])
                t = "".join(parts) + t[at:]
            out.append(t)
        return {**{c: b.column(c) for c in columns}, "text": out}

    return unbundled(map_rows(d.drop("_base"), own.schema, run), docs.columns, "text")
