"""Personal data by bootstrapped contextual extraction.

Base patterns find e-mail addresses, IP addresses, card and phone numbers: the seeds. Looser patterns find
candidates of the same kinds (and `key`, access keys), far too many to report. One scan of the texts yields both,
each with its lexical patterns: the two words before it, and the word before with the word after. The patterns
and the instances (hashes of the whole strings found) form a graph, which Spark scores in rounds: a pattern is trusted as far as
the instances it occurs with are, an instance as far as its best pattern is; seeds are trusted fully. Candidates
that stand in a trusted pattern are reported beside the base spans, which always stay.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.scratch import Scratch, slices

# Local parts of addresses have 64 characters at most and labels of host names 63 (RFC 5321, RFC 1035); the loose patterns keep to that.
#: Kinds in the order of results; `key` has no base pattern.
KINDS = ("email", "ip", "card", "phone", "key")
#: Rounds; distinct trusted instances that a pattern needs; trust from which a pattern reports.
ROUNDS, SUPPORT, TRUST = 3, 3, 0.6
#: Characters before a span in which its context is looked for (blank space or a token beyond that isn't a lexical context), and characters by which a token of a context is known.
BACK, TOKEN = 200, 40

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can start inside a run of digits only if one from the run's start fails the same way, so runs are tried once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_LOOSE = {
    "email": re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}[ ]?(?:\(at\)|\[at\]|@)[ ]?[\w-]{1,63}(?:(?:\.|[ ]?\(dot\)[ ]?|[ ]?\[dot\][ ]?)[\w-]{1,63})+", re.I),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[.:_-][0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ .-]?[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\([0-9]{2,4}\)|[0-9]{2,5})(?:[ ().-]{1,2}[0-9]{2,5}){1,4}(?![0-9])"),
    "key": re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+"),
}
_SEED_KEY = re.compile(r"[0-9a-f]{32,}")
_AT = re.compile(r"@|\(at\)|\[at\]", re.I)
_DIGITS = re.compile(r"[^0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping matches of the base pattern, found from each @ outwards so that long runs take linear time."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind and start."""
    if not _ANY.search(text):
        return []
    out = [("email", s, e) for s, e in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _DIGITS.sub("", m[0])) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGITS.sub("", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, seed) of what looks like a kind and overlaps no base span or earlier candidate; base spans are seeds."""
    starts, ends = [], []  # of what is taken, apart from each other and in order
    for s, e in sorted((s, e) for _, s, e in base):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    out = [(k, s, e, True) for k, s, e in base]
    for kind, pattern in _LOOSE.items():
        if kind == "email" and not _AT.search(text):
            continue
        for m in pattern.finditer(text):
            if kind == "key" and not (any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0])):
                continue
            if kind == "phone" and not 7 <= len(_DIGITS.sub("", m[0])) <= 15:
                continue
            s, e = m.span()
            at = bisect.bisect_left(starts, e)
            if not at or ends[at - 1] <= s:
                out.append((kind, s, e, kind == "key" and bool(_SEED_KEY.fullmatch(text, s, e))))
                starts.insert(at, s)
                ends.insert(at, e)
    return out


def _word_before(text: str, at: int) -> tuple[str, int]:
    """The token (with what sticks to it) that ends before at on the same line, lower-cased, digits as 0; and its start."""
    line = text.rfind("\n", max(0, at - BACK), at) + 1 or max(0, at - BACK)
    left = text[line:at].rstrip()
    start = max(left.rfind(" "), left.rfind("\t")) + 1
    return re.sub("[0-9]", "0", left[start:].lower())[-TOKEN:], line + start


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span: the two tokens before it, and the token before with the token after. Quotes and brackets that touch the span are part of them."""
    edge = start
    while edge > 0 and text[edge - 1] in "\"'([{<":
        edge -= 1
    first, at = _word_before(text, edge)
    second, _ = _word_before(text, at)
    after = re.match(r"[^\n\w]{0,4}(?:[^\W]{1,30})?", text[end : end + TOKEN])[0].strip().lower()
    touch = text[edge:start]
    out = []
    if first:
        if second:
            out.append(f"{second} {first} {touch}_")
        if after:
            out.append(f"{first} {touch}_ {re.sub('[0-9]', '0', after)}")
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("row_key", pa.int64()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("base", pa.bool_()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])
    for batch in slices(batches):
        rows = []
        for key, text in zip(batch["row_key"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if not text:
                continue
            base = base_spans(text)
            known = set(base)
            if base or _ANY.search(text) or _AT.search(text):
                rows += [(key, k, s, e, seed, (k, s, e) in known, hashlib.blake2b(text[s:e].encode("utf-8", "surrogatepass"), digest_size=16).hexdigest(), contexts(text, s, e)) for k, s, e, seed in candidates(text, base)]
        columns = list(zip(*rows, strict=True)) or [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def trusted_patterns(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(pattern, kind, trust) of the patterns trusted after ROUNDS rounds over edges (pattern, kind, instance, seed).

    Trust of a pattern for a kind: the mean trust of its distinct instances that look like the kind; those with
    less than SUPPORT of it in sum, or a mean under TRUST, have none.
    """
    known = edges.where("seed").select("kind", "instance").distinct().withColumn("trust", F.lit(1.0))
    patterns = None
    for step in range(ROUNDS):
        scored = edges.join(known, ["kind", "instance"], "left")
        patterns = scored.groupBy("pattern", "kind").agg(F.sum(F.coalesce("trust", F.lit(0.0))).alias("sum"), F.count("*").alias("n"))
        patterns = patterns.select("pattern", "kind", "sum", (F.col("sum") / F.col("n")).alias("trust")).where((F.col("sum") >= SUPPORT) & (F.col("trust") >= TRUST))
        patterns = scratch.save(patterns.select("pattern", "kind", "trust"), f"patterns-{step}")
        best = edges.where("not seed").join(patterns, ["pattern", "kind"]).groupBy("kind", "instance").agg(F.max("trust").alias("trust"))
        seeds = edges.where("seed").select("kind", "instance").distinct().withColumn("trust", F.lit(1.0))
        known = scratch.save(seeds.unionByName(best), f"known-{step}").groupBy("kind", "instance").agg(F.max("trust").alias("trust"))
    return patterns


def _told(spans: Column) -> Column:
    """kind:start:end of an array of (rank, start, end, kind) structs in their order, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data in every text.

    Returns doc_id, n_email, n_ip, n_card, n_phone (base spans), n_added (spans that the contexts add), n_spans (all), base_sha256
    (of the base spans as kind:start:end, by kind and start) and spans (base and added ones, by kind and start).
    Offsets are code points, ends exclusive. A row for each row of df; null and empty texts have no spans; rows
    equal in id and text are one in the graph and each get its spans. Other columns are ignored whatever their
    names; texts of any length are searched whole. An empty df gives an empty result.
    """
    scratch = Scratch(df.sparkSession, "pii")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    found = docs.select("row_key", "text").mapInArrow(_scan, "row_key long, kind string, start long, end long, seed boolean, base boolean, instance string, patterns array<string>")
    found = scratch.save(found, "found")
    edges = found.select(F.explode("patterns").alias("pattern"), "kind", "instance", "seed").groupBy("pattern", "kind", "instance").agg(F.max("seed").alias("seed"))
    trusted = trusted_patterns(scratch.save(edges, "edges"), scratch)
    added = found.where("not base").select("row_key", "kind", "start", "end", F.explode("patterns").alias("pattern")).join(trusted, ["pattern", "kind"]).select("row_key", "kind", "start", "end", F.lit(False).alias("base"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = found.where("base").select("row_key", "kind", "start", "end", "base").unionByName(added)
    held = spans.groupBy("row_key").agg(F.collect_set(F.struct(rank.alias("rank"), "start", "end", "kind", "base")).alias("spans"))
    of = lambda keep: F.filter(F.coalesce("spans", F.array()), keep)
    rows = docs.select("doc_id", "row_key").join(held, "row_key", "left").withColumn("base", of(lambda s: s["base"]))
    of_kind = lambda k: F.filter("base", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS[:4]]
    return rows.select("doc_id", *counts, F.size(of(lambda s: ~s["base"])).cast("long").alias("n_added"), F.size(of(lambda s: F.lit(True))).cast("long").alias("n_spans"), F.sha2(_told(F.col("base")), 256).alias("base_sha256"), _told(F.coalesce("spans", F.col("base"))).alias("spans"))
