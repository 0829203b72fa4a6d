"""Mixing documents to target weights by soft domain membership, with
DataFrame functions only.

A classifier fitted on labelled documents gives every document posteriors over
the domains: a naive Bayes over counts of letter groups, tempered to an
evidence of ``TEMPER`` letters so that memberships stay soft.  Document rates
``r >= 0`` are then fitted by projected-gradient least squares on

    f(r) = 1/2 sum_k (sum_d r_d n_d p_dk - T_k)^2 / S_k

(``n`` tokens, ``p`` posteriors, ``T`` target tokens, ``S`` tokens at r = 1),
from r = 1, in the metric of the tokens.  Posteriors sum to 1, so the
curvature is at most 1 and the step is 1.  One round is one aggregation over a narrow table; the
driver holds only sums per domain.  Given those, posterior and rate are
expressions of the text, so rates are applied without a join.

With a largest rate ``most`` the descent is projected on rates up to ``most``, and
no domain's target is over ``most / 2`` times its tokens: what a rare domain
cannot take is left to the others in proportion to their weights.  ``Rates``
tells targets and reached totals; a missed target is also a warning.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Letter groups told apart, both cases; the last group is every other
#: character.  Blanks are counted as token ends.
GROUPS = ("éèêëàâçîïôûùœ", "áíóúñ¿¡", "äöüß", "w", "k", "z", "h", "q", "j", "y", "aeiou")
TEMPER = 96.0
MOST_DOMAINS = 32
ROUNDS = 60
TOLERANCE = 1e-4
#: Rounds after which rates are written, so that expressions stay small.
KEEP_EVERY = 12


def _once(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with columns that are computed once per row, however often later
    expressions use them (a generator is not inlined)."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def _marks() -> tuple[str, str]:
    """Arguments of ``translate``: group letters and blanks become marks,
    other printable ASCII goes, the rest stays (and is no mark)."""
    old, new = "", ""
    for i, group in enumerate(GROUPS):
        for c in group + group.upper():
            if c not in old and len(c) == 1:
                old, new = old + c, new + chr(0xE000 + i)
    old, new = old + " \t\n\r", new + chr(0xE000 + len(GROUPS)) * 4
    return old + "".join(chr(i) for i in range(33, 127) if chr(i) not in old), new


@dataclass(frozen=True)
class Domains:
    """Names, log priors and log letter shares of the domains."""

    names: tuple[str, ...]
    prior: tuple[float, ...]
    letters: tuple[tuple[float, ...], ...]

    def with_posteriors(self, df: DataFrame) -> DataFrame:
        """``df`` (``__letters``) with ``p``, array<double> over the domains;
        no letters give the prior."""
        df = _once(df, __all=F.aggregate("__letters", F.lit(0.0), lambda a, x: a + x))
        scale = F.when(F.col("__all") > 0, F.least(F.lit(TEMPER), F.col("__all")) / F.col("__all")).otherwise(0.0)
        logs = [f"__z{i}" for i in range(len(self.names))]
        dots = [sum((F.col("__letters")[j] * w for j, w in enumerate(row)), F.lit(0.0)) for row in self.letters]
        df = _once(df, **{z: F.lit(p) + scale * d for z, p, d in zip(logs, self.prior, dots)})
        top = F.greatest(*logs) if len(logs) > 1 else F.col(logs[0])
        df = _once(df, __e=F.array(*[F.exp(F.col(z) - top) for z in logs]))
        norm = sum((F.col("__e")[i] for i in range(1, len(logs))), F.col("__e")[0])
        return _once(df, p=F.array(*[F.col("__e")[i] / norm for i in range(len(logs))])).drop("__all", "__e", *logs)


def measured(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with ``__tokens`` (fields between blanks) and ``__letters``
    (array<double>, letters of each group and the rest)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = _once(df, __short=F.translate(text, *_marks()), __len=F.length(text))
    count = lambda i: (F.length("__short") - F.length(F.replace(F.col("__short"), F.lit(chr(0xE000 + i)), F.lit("")))).cast("double")
    n = len(GROUPS)
    df = _once(df, **{f"__c{i}": count(i) for i in range(n + 1)})
    rest = F.col("__len") - sum((F.col(f"__c{i}") for i in range(1, n + 1)), F.col("__c0"))
    tokens = F.when(F.col("__len") > 0, F.col(f"__c{n}") + 1).otherwise(0.0)
    df = _once(df, __tokens=tokens, __letters=F.array(*[F.col(f"__c{i}") for i in range(n)], rest))
    return df.drop("__short", "__len", *[f"__c{i}" for i in range(n + 1)])


def fit_domains(labelled: DataFrame, domain_col: str = "domain", weights: Iterable[str] = ()) -> Domains:
    """The classifier from measured rows (``__letters``) with a domain; null
    domains are left out.  One aggregation, a row per domain.  Of more than
    ``MOST_DOMAINS`` domains those not in ``weights`` become one, ``other``."""
    sums = [F.sum(F.col("__letters")[i]).alias(f"g{i}") for i in range(len(GROUPS) + 1)]
    each = (
        labelled.where(F.col(domain_col).isNotNull())
        .groupBy(F.col(domain_col).cast("string").alias("domain"))
        .agg(F.count("*").alias("n"), *sums)
    )
    rows = each.orderBy("domain").limit(MOST_DOMAINS + 1).collect()
    if len(rows) > MOST_DOMAINS:
        named, other = sorted(weights), "other"
        while other in named:
            other += "_"
        name = F.when(F.col("domain").isin(named), F.col("domain")).otherwise(other).alias("domain")
        rows = each.groupBy(name).agg(*[F.sum(c).alias(c) for c in each.columns[1:]]).orderBy("domain").collect()
    docs = sum(r["n"] for r in rows)
    letters = []
    for r in rows:
        g = [r[f"g{i}"] + 1.0 for i in range(len(GROUPS) + 1)]
        letters.append(tuple(math.log(x / sum(g)) for x in g))
    return Domains(tuple(r["domain"] for r in rows), tuple(math.log(r["n"] / docs) for r in rows), tuple(letters))


@dataclass(frozen=True)
class Rates:
    """The steps of the fit: each lowers a document's rate by the product of
    its posteriors with the step, and cuts it at 0 (and at ``most``)."""

    steps: tuple[tuple[float, ...], ...]
    targets: tuple[float, ...]
    reached: tuple[float, ...]
    most: float | None = None

    def rate(self, posteriors: Column, start: Column | None = None, first: int = 0) -> Column:
        r = F.lit(1.0) if start is None else start
        if len(self.steps) == first:
            return r
        steps = F.array(*[F.array(*map(F.lit, s)) for s in self.steps[first:]])
        dot = lambda s: F.aggregate(F.zip_with(posteriors, s, lambda p, x: p * x), F.lit(0.0), lambda a, x: a + x)
        top = (lambda c: c) if self.most is None else (lambda c: F.least(F.lit(float(self.most)), c))
        return F.aggregate(steps, r, lambda acc, s: top(F.greatest(F.lit(0.0), acc - dot(s))))


def bounded_targets(now: list[float], want: list[float], most: float) -> list[float]:
    """Token targets in the proportions ``want`` (0: no part) at the least total
    at which no domain shrinks, none over ``most`` times its tokens: domains
    that would be stay there, and the total is that of the others."""
    held: set[int] = set()
    while True:
        open_ = [i for i, w in enumerate(want) if w > 0 and i not in held]
        if not open_:
            return [most * now[i] if i in held else 0.0 for i in range(len(now))]
        unit = max(now[i] / want[i] for i in open_)
        over = [i for i in open_ if want[i] * unit > most * now[i]]
        if not over:
            return [most * now[i] if i in held else want[i] * unit for i in range(len(now))]
        # The rarest against its weight goes first; the others may then fit.
        held.add(min(over, key=lambda i: now[i] / want[i]))


def fit_rates(rows: DataFrame, names: tuple[str, ...], weights: dict[str, float], total: float | None = None, most: float | None = None) -> Rates:
    """Rates for ``rows`` (``__tokens``, ``p``) that bring the expected tokens
    of each domain to its share of ``total``.  By default ``total`` is the
    least one at which no domain has to give up tokens.  ``most`` (2 or more)
    bounds rates and targets, see above.  Domains without tokens or weight do
    not take part."""
    if most is not None and most < 2:
        raise ValueError(f"largest rate {most}: at least 2 is needed")
    k = len(names)
    if not k:
        return Rates((), (), ())

    def totals(table: DataFrame, rate: Column) -> list[float]:
        got = table.withColumn("__w", F.col("__tokens") * rate).agg(*[F.sum(F.col("__w") * F.col("p")[i]) for i in range(k)]).first()
        return [x or 0.0 for x in got]

    now = totals(rows, F.lit(1.0))
    active = [now[i] > 0 and weights.get(names[i], 0) > 0 for i in range(k)]
    share = sum(weights.get(names[i], 0) for i in range(k) if active[i])
    if not share:
        return Rates((), tuple(now), tuple(now))
    want = [weights.get(names[i], 0) / share if active[i] else 0.0 for i in range(k)]
    if total is None and most is not None:
        target = bounded_targets(now, want, most / 2)
    else:
        if total is None:
            total = max(now[i] / want[i] for i in range(k) if active[i])
        target = [w * total for w in want]
    start = now
    steps: list[tuple[float, ...]] = []
    base, done = rows, 0
    for _ in range(ROUNDS):
        error = [(now[i] - target[i]) if active[i] else 0.0 for i in range(k)]
        if max(abs(e) / t for e, t in zip(error, target) if t) < TOLERANCE:
            break
        steps.append(tuple(e / s if s else 0.0 for e, s in zip(error, start)))
        part = Rates(tuple(steps), (), (), most)
        rate = part.rate(F.col("p"), F.col("__r") if done else None, done)
        if len(steps) - done == KEEP_EVERY:
            base = stored(base.withColumn("__r2", rate).drop("__r").withColumnRenamed("__r2", "__r"), "mixing-rates")
            done, rate = len(steps), F.col("__r")
        now = totals(base, rate)
    missed = {names[i]: round(now[i] / target[i], 4) for i in range(k) if target[i] and abs(now[i] / target[i] - 1) > TOLERANCE}
    if missed:
        warnings.warn(f"domains off their target tokens (reached / target): {missed}", stacklevel=2)
    return Rates(tuple(steps), tuple(target), tuple(now), most)


def copies(rate: Column, key: Column) -> Column:
    """Whole copies for a rate: its floor, and one more with the probability
    of its fraction, decided by a hash of the key."""
    u = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("int")).cast("int")


def fit(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], id_col: str, text_col: str, domain_col: str, most: float | None = None) -> tuple[Domains, Rates, DataFrame]:
    """Domains from the documents that ``labelled`` (id, domain) covers, rates
    over all of ``docs``, and the narrow table of ids, tokens and posteriors.
    Texts are measured once; only measures meet the labelled table.  Ids with
    contradicting domains count as unlabelled."""
    rows = stored(measured(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), "text").drop("text"), "mixing-measures")
    tags = labelled.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.when(F.min(domain_col) == F.max(domain_col), F.min(domain_col)).alias("domain")
    )
    domains = fit_domains(rows.join(tags, "id"), weights=[n for n, w in weights.items() if w > 0])
    if not domains.names:
        rows = rows.withColumn("p", F.array().cast("array<double>"))
    else:
        rows = domains.with_posteriors(rows)
    rows = stored(rows.select("id", "__tokens", "p"), "mixing-rows")
    return domains, fit_rates(rows, domains.names, weights, most=most), rows


def labelled_by(docs: DataFrame, labels: DataFrame, domain: str, id_col: str = "doc_id") -> DataFrame:
    """(id, domain) of the documents that the labelled table covers: their
    ``domain`` tag is trusted, that of the others is not used."""
    ids = labels.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    return docs.select(id_col, docs[domain].alias("domain")).join(ids, id_col, "left_semi")


def document_rates(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", most: float | None = None
) -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``p_<domain>`` per labelled
    domain, ``rate`` (0 or more) and ``copies``.  Of more than ``MOST_DOMAINS``
    domains those without weight are one, ``other``.

    Null and empty texts have no tokens and the prior as posteriors; null or
    repeated ids keep their rows.  Without labelled domains, or where no
    weighted domain has tokens, every rate is 1.  Other columns are not read.
    """
    domains, rates, rows = fit(docs, labelled, weights, id_col, text_col, domain_col, most)
    rows = _once(rows, rate=rates.rate(F.col("p")))
    return rows.select(
        F.col("id").alias(id_col),
        F.col("__tokens").cast("long").alias("n_tokens"),
        *[F.col("p")[i].alias(f"p_{n}") for i, n in enumerate(domains.names)],
        "rate",
        copies(F.col("rate"), F.col("id")).alias("copies"),
    )


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", most: float | None = None) -> DataFrame:
    """``docs`` with every row repeated by its rate's copies (at most ``most``), columns
    as they are, clashing names too; one pass, no join.  Null and empty texts
    have the prior's rate; an empty table stays empty."""
    domains, rates, _ = fit(docs, labelled, weights, id_col, text_col, domain_col, most)
    if not rates.steps:
        return docs
    names = [f"__d{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    at = lambda c: names[docs.columns.index(c)]
    rows = _once(domains.with_posteriors(measured(plain, at(text_col))), __rate=rates.rate(F.col("p")))
    rows = rows.withColumn("__copies", copies(F.col("__rate"), F.col(at(id_col))))
    return rows.where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*names).toDF(*docs.columns)
