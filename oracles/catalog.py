"""All oracle statements, ready to run on the supplied tables."""

from __future__ import annotations

from oracles.ctes import with_tables
from oracles.queries import ORACLES
from oracles.reports import REPORT_ORACLES
from oracles.shared import EXTRA


def statements() -> dict[str, str]:
    return {name: with_tables(text, EXTRA) for name, text in {**ORACLES, **REPORT_ORACLES}.items()}
