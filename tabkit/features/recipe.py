"""A feature recipe: roles, steps learned on training rows, and their application.

A step's ``fit`` runs Spark aggregates and keeps only bounded facts (means, kept
levels, knots). Most fitted steps are a list of SQL expressions, so applying a
recipe is one projection that Catalyst collapses, and a fitted recipe is saved
like any other model.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.operators.frames import typed

Selector = Callable[[DataFrame, dict[str, str]], list[str]]


def q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def lit(v) -> str:
    """A value as SQL text."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"double('{v!r}')"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def safe_name(s: str) -> str:
    """Letters and digits of any script; other signs become _."""
    return re.sub(r"[\W_]+", "_", s)


def unique_names(values) -> dict[str, str]:
    """A name per value; values that differ in signs only get _2, _3, ... in their order."""
    out, seen = {}, set()
    for v in values:
        base = name = safe_name(v)
        i = 1
        while name in seen:
            i += 1
            name = f"{base}_{i}"
        seen.add(name)
        out[v] = name
    return out


# ---- selectors --------------------------------------------------------------


def _predictors(df, roles):
    return [c for c in df.columns if roles.get(c, "predictor") == "predictor"]


def all_predictors() -> Selector:
    return _predictors


def all_numeric_predictors() -> Selector:
    return lambda df, roles: [c for c in _predictors(df, roles) if c in typed(df, "numeric")]


def all_nominal_predictors() -> Selector:
    return lambda df, roles: [c for c in _predictors(df, roles) if c in typed(df, "string")]


def all_outcomes() -> Selector:
    return lambda df, roles: [c for c in df.columns if roles.get(c) == "outcome"]


def has_role(role: str) -> Selector:
    return lambda df, roles: [c for c in df.columns if roles.get(c, "predictor") == role]


def matches(pattern: str) -> Selector:
    return lambda df, roles: [c for c in df.columns if re.search(pattern, c, re.I)]


def resolve(select: Selector | Sequence[str], df: DataFrame, roles: dict[str, str]) -> list[str]:
    return list(select(df, roles)) if callable(select) else [c for c in select if c in df.columns]


# ---- fitted forms -----------------------------------------------------------


class LearnedColumns(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted step: named SQL expressions, then dropped columns."""

    assign = Param(Params._dummy(), "assign", "pairs of column and SQL expression", TypeConverters.identity)
    drop = Param(Params._dummy(), "drop", "columns to drop", TypeConverters.toListString)

    def __init__(self, assign=None, drop=None):
        super().__init__()
        self._set(assign=[list(p) for p in (assign or [])], drop=list(drop or []))

    def _transform(self, df: DataFrame) -> DataFrame:
        pairs = self.getOrDefault(self.assign)
        if pairs:
            df = df.withColumns({c: F.expr(e) for c, e in pairs})
        return df.drop(*self.getOrDefault(self.drop))


class RowChange(Model):
    """Fitted form of a step that changes training rows; new data pass unchanged."""

    def __init__(self, fn: Callable[[DataFrame], DataFrame]):
        super().__init__()
        self.fn = fn

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.fn(df)


class Step(Estimator):
    """A recipe step over selected columns; ``learn`` returns (assign, drop)."""

    training_only = False

    def __init__(self, select: Selector | Sequence[str] = ()):
        super().__init__()
        self.select = select
        self.roles: dict[str, str] = {}

    def learn(self, df: DataFrame, cols: list[str]) -> tuple[list[tuple[str, str]], list[str]]:
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> Model:
        assign, drop = self.learn(df, resolve(self.select, df, self.roles))
        return LearnedColumns(assign, drop)


class Recipe:
    """recipe = Recipe(outcome="y", ids=["id"]).add(StepX(...)); fitted = recipe.prep(train)."""

    def __init__(self, outcome: str | Sequence[str] = (), ids: Sequence[str] = (), roles: dict[str, str] | None = None):
        outcomes = [outcome] if isinstance(outcome, str) else list(outcome)
        self.roles = {**{c: "outcome" for c in outcomes}, **{c: "id" for c in ids}, **(roles or {})}
        self.steps: list[Step] = []

    @classmethod
    def from_formula(cls, formula: str, df: DataFrame, ids: Sequence[str] = ()) -> "Recipe":
        """'y ~ .' or 'y ~ a + b'; columns the formula leaves out get the role 'other'."""
        left, right = [p.strip() for p in formula.split("~")]
        outcome = [t.strip() for t in left.split("+")]
        terms = [t.strip() for t in right.split("+")]
        used = set(df.columns) if "." in terms else set(terms)
        other = {c: "other" for c in df.columns if c not in used and c not in outcome and c not in ids}
        return cls(outcome, ids, other)

    def update_role(self, *cols: str, role: str) -> "Recipe":
        self.roles.update({c: role for c in cols})
        return self

    def add(self, *steps: Step) -> "Recipe":
        self.steps += steps
        return self

    def prep(self, train: DataFrame) -> "Prepared":
        models, df = [], train
        for s in self.steps:
            s.roles = self.roles
            m = s.fit(df)
            df = m.transform(df)
            models.append((m, s.training_only))
        return Prepared(models, df, dict(self.roles))


class Prepared:
    """A fitted recipe."""

    def __init__(self, models: list[tuple[Model, bool]], juiced: DataFrame | None, roles: dict[str, str]):
        self.models, self._juiced, self.roles = models, juiced, roles

    def juice(self) -> DataFrame:
        """The processed training rows."""
        return self._juiced

    def bake(self, df: DataFrame) -> DataFrame:
        """Process new rows; steps that change training rows are passed over."""
        for m, training_only in self.models:
            if not training_only:
                df = m.transform(df)
        return df

    def predictors(self, kind: str | None = None) -> list[str]:
        cols = _predictors(self._juiced, self.roles)
        return [c for c in cols if c in typed(self._juiced, kind)] if kind else cols

    def as_pipeline(self) -> PipelineModel:
        """The steps for new data as one saveable pipeline."""
        return PipelineModel([m for m, training_only in self.models if not training_only])
