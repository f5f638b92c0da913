"""The part of the ledger that a statement needs, read from the ledger once for everything a run writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators import code_filter, match
from tallymark.operators.grouping import distinct_keys, first_per_group
from tallymark.operators.lookup import enrich, narrow_ledger
from tallymark.operators.prepare import nonempty
from tallymark.operators.profile import Profile, profile, within_days
from tallymark.sources.layouts import Layout
from tallymark.sources.ledger import Ledger
from tallymark.sources.scratch import write_packed

# Statements with more codes ask for more authorizations than are shuffled whole by transaction, state and merchant.
MANY_BYTES = 10 << 20
LINE_BYTES = 64
Lookup = Callable[[DataFrame, Ledger], DataFrame]


@dataclass(frozen=True)
class Reduced:
    """Ledger side of a statement. Everything is made when it is first asked for, and then once.

    How the ledger is reduced depends on the statement's measured codes. Codes that fit a broadcast filter it while it is
    scanned, and lookup tables are narrowed to what is left. Up to some thirty times as many are a filter of a few bits for
    each code, and what gets through it by chance meets no line. Beyond that the ledger is grouped before it is reduced,
    which keeps the grouping free to split a hot code.
    """

    lines: DataFrame
    source: Ledger
    layout: Layout
    eligible: Lookup | None = None  # drops authorizations that must not match, before one is picked
    extra: Lookup | None = None  # lookups of the layout's own
    empty_codes: bool = False  # authorizations without a code are looked at too, if lines have none
    order_by: Sequence[str] = tuple(match.AUTHORIZATION_ORDER)
    # What several outputs are made of is written.
    write_matching: bool = False
    write_shown: bool = False

    @cached_property
    def profile(self) -> Profile:
        return profile(self.lines, self.layout)

    @cached_property
    def small(self) -> bool:
        """The codes fit a broadcast."""
        return self.profile.code_bytes <= match.MAX_BROADCAST_BYTES

    @cached_property
    def filtered(self) -> bool:
        """The codes do not, but a filter of them does. Codes under a collation are hashed by no function that Spark offers."""
        plain = self.lines.schema[self.layout.key].dataType == T.StringType()
        return not self.small and plain and code_filter.filter_helps(self.profile.codes)

    @cached_property
    def matching(self) -> DataFrame:
        """Authorizations that lines may match: with all of the statement's codes, and few or no others unless both limits
        are passed. A table read by the export and the statistics of a run."""
        code, made = F.col(self.layout.ledger_key), F.col("fecha_hora_creacion")
        rows = self.source.autorizacion.filter(code.isNotNull() if self.empty_codes else nonempty(self.layout.ledger_key))
        key = [code]
        if self.layout.day:
            rows, key = rows.filter(within_days(made, self.profile.days)), [code, F.to_date(made)]
        if self.small:
            same = reduce(and_, (k == F.col(c) for k, c in zip(key, self.profile.by)))
            rows = rows.join(F.broadcast(self.profile.keys), same, "left_semi")
        elif self.filtered:
            found = write_packed(code_filter.code_filter(self.profile.keys, self.profile.codes), "code-filter")
            rows = code_filter.may_match(rows, key, found, self.profile.codes)
        if self.eligible:
            rows = self.eligible(rows, self.source)
        return write_packed(rows, "matching") if self.write_matching else rows

    @cached_property
    def _picked(self) -> tuple[DataFrame, Ledger]:
        coded = self.matching.filter(nonempty(self.layout.ledger_key)) if self.empty_codes else self.matching
        picked = first_per_group(coded, self.layout.match_columns, self.order_by)
        if self.small:
            return narrow_ledger(self.source, picked)
        if not self.filtered:
            codes = distinct_keys(self.profile.keyed, ["_key"], "_key")
            picked = picked.join(codes, F.col(self.layout.ledger_key) == F.col("_key"), "left_semi")
        return picked, self.source

    @property
    def picked(self) -> DataFrame:
        """One authorization for each combination of the layout's match columns: the one that export rows show."""
        return self._picked[0]

    @property
    def ledger(self) -> Ledger:
        """The ledger whose lookup tables serve ``picked``."""
        return self._picked[1]

    @cached_property
    def codes(self) -> DataFrame:
        """A relation with every code (and day) of the statement that an authorization has."""
        if self.write_shown:
            return self.shown
        return self.picked if self.small and self.ledger is not self.source else self.matching

    @cached_property
    def matched(self) -> DataFrame:
        """Of a statement matched by code and day, the narrow rows of the lines that match; a table read by the export and the
        statistics of a run, unless they are few."""
        # What is shown has one row per code and day, and copies would do a semi join no good.
        days = self.shown.select("codigo_unico_adq", "auth_day") if self.write_shown else match.code_days(self.codes)
        same = (F.col("_key") == F.col("codigo_unico_adq")) & (F.col("_day") == F.col("auth_day"))
        rows = self.profile.keyed.join(days, same, "left_semi")
        return rows if self.few_lines or not self.write_shown else write_packed(rows, "matched-lines")

    @property
    def few_lines(self) -> bool:
        """A narrow row of every line fits a broadcast."""
        return self.profile.lines * LINE_BYTES <= match.MAX_BROADCAST_BYTES

    @cached_property
    def shown(self) -> DataFrame:
        """``picked`` with all lookups: what export rows show. Their chain is walked by ids alone where much is shuffled."""
        picked, ledger = self._picked
        rows = self.extra(picked, ledger) if self.extra else picked
        many = not self.small or self.profile.code_bytes > MANY_BYTES
        rows = enrich(rows, ledger, by_id=many)
        # Of many codes a run writes it too: shuffles of its lookups are gone when lines are shuffled and the export is written.
        return write_packed(rows, "shown") if self.write_shown or many and self.write_matching else rows
