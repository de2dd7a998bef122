"""Every operator as a query over the given tables, with its SQL twin where one exists."""

from tabkit.queries.registry import ORACLE, QUERIES  # noqa: F401


def load() -> None:
    from tabkit.queries import basics, combine, learn, modelling, summaries, temporal  # noqa: F401
