"""Secret scans with a trigram inverted index.

Every rule's regular expression is parsed, and a Boolean trigram query is derived
from the parse: a concatenation needs the trigrams of all its parts and of their
joints, an alternation those of one branch, classes of many characters and
repetitions that may be empty need none. The query is a set of conjunctions. An
inverted index from trigram to document is built for the trigrams that the rules
ask for; the postings of a conjunction are intersected, and only documents that
some conjunction holds for are verified with the rule's expression. A rule whose
query holds a conjunction without trigrams scans all documents. All of it is
DataFrame expressions.

Matches are leftmost and don't overlap within a kind. Positions are code points,
the end is exclusive. Null texts count as empty and have no secrets; null and
repeated ids are judged by their own text, and a text of any length is scanned
whole. Postings name a document by a hash of its text, so copies are one document
and an empty table has none. Spans of the same start are in the order of the
rules. Columns named secrets, __key or __kinds are replaced or dropped, further
ones stay.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.session import materialize

#: Documents with candidates up to this number are broadcast (a long and a few short strings each).
BROADCAST_CANDIDATES = 1_000_000
#: A query is weakened rather than let have more strings or conjunctions than this.
MOST_STRINGS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPAN = "array<struct<start:int,rank:int,stop:int,kind:string,ok:boolean>>"

Query = frozenset[frozenset[str]]
#: No trigram is needed.
ANY: Query = frozenset([frozenset()])


def _low(c: str) -> str:
    return c.lower() if "A" <= c <= "Z" else c


def _trigrams(word: str) -> frozenset[str]:
    return frozenset(word[i : i + 3] for i in range(len(word) - 2))


def _least(found: set[frozenset[str]]) -> Query:
    """Without conjunctions that another one implies; too many are weakened to none."""
    kept = frozenset(x for x in found if not any(y < x for y in found))
    return kept if len(kept) <= MOST_STRINGS else ANY


@dataclass(frozen=True)
class Needs:
    """What a part of an expression needs: exact, all strings it matches, if these are few; otherwise its query, and the
    strings of up to two characters that its matches begin and end with."""

    exact: frozenset[str] | None
    query: Query = ANY
    first: frozenset[str] = frozenset([""])
    last: frozenset[str] = frozenset([""])

    @property
    def begins(self) -> frozenset[str]:
        return frozenset(x[:2] for x in self.exact) if self.exact is not None else self.first

    @property
    def ends(self) -> frozenset[str]:
        return frozenset(x[-2:] for x in self.exact) if self.exact is not None else self.last

    def whole(self) -> Query:
        return self.query if self.exact is None else _least({_trigrams(x) for x in self.exact})


def _then(a: Needs, b: Needs) -> Needs:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST_STRINGS:
        return Needs(frozenset(x + y for x in a.exact for y in b.exact))
    joint = _least({_trigrams(x + y) for x in a.ends for y in b.begins})
    parts = [a.whole(), joint, b.whole()]
    query = reduce(lambda x, y: _least({p | q for p in x for q in y}) if len(x) * len(y) <= MOST_STRINGS**2 else x, parts)
    first = frozenset((x + y)[:2] for x in a.exact for y in b.begins) if a.exact is not None else a.first
    last = frozenset((x + y)[-2:] for x in a.ends for y in b.exact) if b.exact is not None else b.last
    return Needs(None, query, *(x if len(x) <= MOST_STRINGS else frozenset([""]) for x in (first, last)))


def _either(branches: list[Needs]) -> Needs:
    if all(x.exact is not None for x in branches) and sum(len(x.exact) for x in branches) <= MOST_STRINGS:
        return Needs(frozenset().union(*(x.exact for x in branches)))
    ends = [frozenset().union(*(getattr(x, k) for x in branches)) for k in ("begins", "ends")]
    return Needs(None, _least(set().union(*(x.whole() for x in branches))), *(x if len(x) <= MOST_STRINGS else frozenset([""]) for x in ends))


def _class(items: list) -> frozenset[str] | None:
    """The characters of a class, lower-cased; None if they are many or negated."""
    out: set[str] = set()
    for kind, value in items:
        name = str(kind)
        if name == "LITERAL":
            out.add(_low(chr(value)))
        elif name == "RANGE" and value[1] - value[0] < MOST_STRINGS:
            out |= {_low(chr(c)) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(out) if len(out) <= 8 else None


def _needs(parsed) -> Needs:
    """Of a parsed sequence."""
    out = Needs(frozenset([""]))
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            part = Needs(frozenset([_low(chr(value))]))
        elif name == "IN":
            part = Needs(_class(value))
        elif name == "BRANCH":
            part = _either([_needs(b) for b in value[1]])
        elif name == "SUBPATTERN":
            part = _needs(value[-1])
        elif name == "AT":
            part = Needs(frozenset([""]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = value
            once = _needs(inner)
            if least == most == 1:
                part = once
            elif least >= 1:
                part = Needs(None, once.whole(), once.begins, once.ends)
            elif most == 1:
                part = _either([once, Needs(frozenset([""]))])
            else:
                part = Needs(None)
        else:  # any character, look-arounds, references
            part = Needs(None)
        out = _then(out, part)
    return out


def trigram_query(pattern: str) -> Query:
    """Conjunctions of trigrams of lower-cased text, one of which holds wherever the pattern matches."""
    from re import _parser

    return _needs(_parser.parse(pattern)).whole()


@dataclass(frozen=True)
class SecretRule:
    """group of a match must have shortest characters."""

    kind: str
    pattern: str
    group: int = 0
    shortest: int = 1

    @cached_property
    def conjunctions(self) -> list[frozenset[str]]:
        return sorted(trigram_query(self.pattern), key=sorted)

    def scans_fully(self) -> bool:
        return not all(self.conjunctions)

    @cached_property
    def bounded(self) -> str:
        """The pattern, or where only that is left of it, literals and then a run of a class that holds them all: the run with
        shortest characters at least. That matches the same runs, as a shorter one holds no other match."""
        m = re.fullmatch(r"([A-Za-z0-9]*)(\[[A-Za-z0-9-]+\])\+", self.pattern)
        if self.group or not m or not re.fullmatch(f"{m[2]}*", m[1]):
            return self.pattern
        return f"{m[1]}{m[2]}{{{max(1, self.shortest - len(m[1]))},}}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = ("password", "passwd", "secret", "token", "api_?key")
BASE_RULES = (
    SecretRule("assign", "(" + "|".join(_either_case(n) for n in NAMES) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 16),
    SecretRule("hex", r"[0-9a-f]+", 0, 32),
)
#: Public formats beside the base rules.
MORE_RULES = (
    SecretRule("github", r"gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]+=*", 0, 27),
)


def _any_of(trigrams: list[str]) -> str:
    """An expression that finds, at each place, the trigram that begins there, branching by its characters."""
    tree: dict[str, dict[str, list[str]]] = {}
    for t in trigrams:
        tree.setdefault(t[0], {}).setdefault(t[1], []).append(re.escape(t[2]))
    second = lambda own: "|".join(f"{re.escape(b)}(?:{'|'.join(c)})" for b, c in own.items())
    return "(?=(" + "|".join(f"{re.escape(a)}(?:{second(own)})" for a, own in tree.items()) + "))"


def trigram_postings(df: DataFrame, trigrams: list[str], text: str) -> DataFrame:
    """The inverted index (trigram, key) over lower-cased texts, for these trigrams: each text is cut once. key is the text's hash."""
    held = F.array_distinct(F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(_any_of(trigrams)), F.lit(1)))
    return df.select(F.xxhash64(text).alias("key"), F.explode(held).alias("trigram"))


def candidates(df: DataFrame, rules: tuple[SecretRule, ...], text: str) -> DataFrame:
    """(key, kinds): texts in the intersected postings of each rule that has mandatory trigrams."""
    wanted = [(r.kind, k, t, len(alt)) for r in rules if not r.scans_fully() for k, alt in enumerate(r.conjunctions) for t in sorted(alt)]
    trigrams = sorted({t for _, _, t, _ in wanted})
    if not trigrams:
        return df.select(F.xxhash64(text).alias("key"), F.array(F.lit("")).alias("kinds")).limit(0)
    queries = F.map_from_arrays(
        F.array(*map(F.lit, trigrams)),
        F.array(*(F.array(*(F.struct(F.lit(kind).alias("kind"), F.lit(k).alias("alternative"), F.lit(n).alias("needed")) for kind, k, own, n in wanted if own == t)) for t in trigrams)),
    )
    postings = trigram_postings(df, trigrams, text)
    asked = postings.select("key", "trigram", F.explode(F.element_at(queries, F.col("trigram"))).alias("q")).select("key", "trigram", "q.*")
    met = asked.groupBy("key", "kind", "alternative", "needed").agg(F.count_distinct("trigram").alias("found")).where("found = needed")
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def running(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What step has made of all values before each one, beginning with zero. In blocks of the root of the size, since an
    aggregate copies the array that it appends to at each step."""
    n = F.size(values)
    width = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    blocks = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int")), lambda k: F.slice(values, k * width + 1, width))).otherwise(F.array(values))

    def scan(items: Column, first: Column, one: Callable[[Column, Column], Column]) -> Column:
        begin = F.struct(first.alias("now"), F.filter(F.array(first), lambda x: F.lit(False)).alias("out"))
        return F.aggregate(items, begin, lambda acc, x: F.struct(one(acc["now"], x).alias("now"), F.array_append(acc["out"], acc["now"]).alias("out")))["out"]

    starts = scan(blocks, zero, lambda now, block: F.aggregate(block, now, step))
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), starts.alias("s")), lambda x: scan(x["b"], x["s"], step)))


def spans(text: Column, rule: SecretRule, rank: int) -> Column:
    """Array of (start, rank, stop, kind) of the rule's matches that are long enough, in order."""
    found = F.regexp_extract_all(text, F.lit(rule.bounded), F.lit(0))
    gaps = F.transform(F.split(text, rule.bounded, -1), F.length)
    held = F.transform(found, lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group) if rule.group else m))
    pairs = F.arrays_zip(F.transform(found, F.length).alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("g"), held.alias("h"))

    def place(x: Column, at: Column) -> Column:
        begin = at + x["g"]
        return F.struct(begin.alias("start"), F.lit(rank).alias("rank"), (begin + x["m"]).alias("stop"), F.lit(rule.kind).alias("kind"), (x["h"] >= rule.shortest).alias("ok"))

    ends = running(pairs, F.lit(0), lambda at, x: at + x["g"] + x["m"])
    return F.filter(F.zip_with(pairs, ends, place), lambda x: x["ok"])


def scan(df: DataFrame, rules: tuple[SecretRule, ...] = BASE_RULES + MORE_RULES, text: str = "text") -> DataFrame:
    """Adds secrets: array of (start, rank, stop, kind), by start and then by the rules' order."""
    own = df.drop("secrets", "__key", "__kinds")
    found = materialize(candidates(own.select(F.col(text)), rules, text), "candidates")
    few = found.count() <= BROADCAST_CANDIDATES
    found = found.withColumnRenamed("key", "__key").withColumnRenamed("kinds", "__kinds")
    found = F.broadcast(found) if few else found
    joined = own.join(found, F.xxhash64(text) == F.col("__key"), "left").drop("__key")
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.from_json(F.lit("[]"), SPAN)
    parts = []
    for rank, rule in enumerate(rules):
        asked = F.col(text).isNotNull() if rule.scans_fully() else F.array_contains("__kinds", rule.kind)
        parts.append(F.when(asked & whole.rlike(rule.bounded), spans(whole, rule, rank)).otherwise(none))
    flat = F.transform(F.array_sort(F.concat(*parts)), lambda x: x.dropFields("ok"))
    return joined.withColumn("secrets", flat).drop("__kinds")


def as_text(secrets: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(secrets, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def redact(text: Column, secrets: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by the mark."""
    ends = running(secrets, F.lit(0), lambda at, x: F.greatest(at, x["stop"]))
    pieces = F.zip_with(secrets, ends, lambda x, at: F.when(x["start"] >= at, F.concat(F.substring(text, at + 1, x["start"] - at), F.lit(mark))).otherwise(""))
    rest = F.substring(text, F.array_max(F.transform(secrets, lambda x: x["stop"])) + 1, F.length(text))
    return F.when(F.size(secrets) == 0, text).otherwise(F.concat(F.array_join(pieces, ""), rest))


def duckdb_sql(rules: tuple[SecretRule, ...] = BASE_RULES + MORE_RULES, base: int = len(BASE_RULES)) -> str:
    """Counts and spans over documents, each rule run over each text."""
    parts = []
    for rank, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        held = f"length(regexp_extract(t, '{pattern}', {r.group}))" if r.group else "length(t)"
        parts.append(
            f"""SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, a AS start, a + length(t) AS stop FROM (
  SELECT doc_id, unnest(m) AS t, unnest(list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))) AS a
  FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS m, string_split_regex(text, '{pattern}') AS g FROM documents WHERE text IS NOT NULL)) WHERE {held} >= {r.shortest}"""
        )
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in rules[:base])
    joined = "string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank)"
    return f"""WITH s AS ({" UNION ALL ".join(parts)})
SELECT d.doc_id, {counts}, sha256(coalesce({joined} FILTER (rank < {base}), '')) AS base_sha256, coalesce({joined} FILTER (kind IS NOT NULL), '') AS spans FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""
