"""Pieces of DuckDB SQL text used by the oracle queries (the same rules as the Column functions)."""

from __future__ import annotations

from ..functions.text import PY_WHITESPACE

WS = PY_WHITESPACE.replace("'", "''")
TOK = r"[\p{L}\p{N}]+"
LINES = "\\r\\n|[\\n\\x{0B}\\x{0C}\\r\\x{1C}\\x{1D}\\x{1E}\\x{85}\\x{2028}\\x{2029}]"


def strip(x: str) -> str:
    return f"trim({x}, '{WS}')"


def rest(x: str) -> str:
    return f"(CASE WHEN strpos({x}, chr(10)) > 0 THEN substr({x}, strpos({x}, chr(10)) + 1) ELSE '' END)"


def doc_filename(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return f"('/corpus/' || {a}source || '/doc_' || CAST({a}doc_id AS VARCHAR) || '.txt')"


def conv_filename(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return f"('/chats/conv_' || CAST({a}conv_id AS VARCHAR) || '.txt')"
