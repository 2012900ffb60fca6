"""Common table expressions of the contract tables, in DuckDB's dialect."""

from __future__ import annotations

import re

from shelfstream.sources.testbed import TABLES, render


def with_tables(query: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``query`` with the CTEs of every ``{table}`` it mentions."""
    extra = extra or {}
    ordered: list[str] = []

    def text_of(name: str) -> str:
        return extra[name] if name in extra else render(name, "TIMESTAMP", "list_value")

    def visit(name: str) -> None:
        if name in ordered or (name not in TABLES and name not in extra):
            return
        for ref in sorted(set(re.findall(r"\{([a-z]\w*)\}", text_of(name)))):
            visit(ref)
        ordered.append(name)

    for ref in sorted(set(re.findall(r"\{([a-z]\w*)\}", query))):
        visit(ref)

    def plain(text: str) -> str:
        return re.sub(
            r"\{([a-z]\w*)\}",
            lambda m: f'"ct_{m[1]}"' if (m[1] in TABLES or m[1] in extra) else m[1],
            text,
        )

    ctes = ",\n".join(f'"ct_{name}" AS ({plain(text_of(name))})' for name in ordered)
    return (f"WITH {ctes}\n" if ctes else "") + plain(query)
