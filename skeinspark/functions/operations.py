"""Methods and operations as classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import col, first_match

# Words that open an operation of each class, in order of the classes.
HTTP_READ, HTTP_WRITE, HTTP_OTHER = ("GET", "HEAD", "OPTIONS", "TRACE"), ("POST", "PUT", "PATCH", "DELETE"), ("CONNECT",)
SQL = (
    ("read", ("SELECT", "FIND", "GET", "READ", "QUERY", "FETCH", "LOAD", "LIST", "SEARCH", "COUNT")),
    ("write", ("INSERT", "UPDATE", "DELETE", "UPSERT", "SAVE", "PUT", "MERGE", "REPLACE", "REMOVE")),
    ("ddl", ("CREATE", "ALTER", "DROP", "TRUNCATE", "RENAME", "GRANT", "REVOKE")),
    ("transaction", ("BEGIN", "COMMIT", "ROLLBACK", "SAVEPOINT", r"START\s+TRANSACTION")),
    ("metadata", ("EXPLAIN", "ANALYZE", "DESCRIBE", "SHOW", "SET")),
)
RPC = (
    ("stream", ("Stream", "Watch", "Subscribe", "Listen", "Observe")),
    ("read", ("Get", "List", "Find", "Query", "Read", "Fetch", "Search", "Load", "Describe", "Check", "Validate", "Verify", "Lookup", "Resolve")),
    ("write", ("Create", "Update", "Delete", "Set", "Add", "Remove", "Put", "Insert", "Upsert", "Save", "Modify", "Patch", "Store", "Register", "Unregister")),
)
MESSAGING = (
    (r"\b(publish|send|produce|emit|dispatch)\b", "publish"),
    (r"\b(consume|receive|subscribe|poll|fetch)\b", "consume"),
    (r"\b(ack|nack|reject|commit|acknowledge)\b", "ack"),
)


def http_method(method: Column | str) -> Column:
    """read, write or other; anything that is no method is unknown."""
    m = F.upper(F.trim(col(method)))
    return F.when(m.isin(*HTTP_READ), "read").when(m.isin(*HTTP_WRITE), "write").when(m.isin(*HTTP_OTHER), "other").otherwise("unknown")


def is_read_method(method: Column | str) -> Column:
    return http_method(method) == "read"


def is_write_method(method: Column | str) -> Column:
    return http_method(method) == "write"


def _sql_rules(classes: tuple[str, ...]) -> list[tuple[str, str]]:
    return [(rf"^(?:{'|'.join(words)})\b", name) for name, words in SQL if name in classes]


def _rpc(name: Column, otherwise: str | Column) -> Column:
    return first_match(name, [(rf"^(?:{'|'.join(words)})", kind) for kind, words in RPC], otherwise)


def sql_operation(operation: Column | str) -> Column:
    """read, write, ddl, transaction, metadata or other, by the first word; null and empty are other."""
    return first_match(F.upper(F.trim(F.coalesce(col(operation), F.lit("")))), _sql_rules(tuple(n for n, _ in SQL)), "other")


def rpc_operation(method: Column | str) -> Column:
    """stream, read or write by how the last path segment begins, case-sensitive."""
    return _rpc(F.element_at(F.split(F.coalesce(col(method), F.lit("")), "/"), -1), "other")


def messaging_operation(operation: Column | str) -> Column:
    return first_match(F.lower(F.coalesce(col(operation), F.lit(""))), MESSAGING, "other")


def operation_bucket(operation: Column | str, kind: str | None = None) -> Column:
    """By the kind that is named (sql or db, rpc or grpc, messaging); else SQL reads, writes and ddl, then RPC prefixes."""
    known = {"sql": sql_operation, "db": sql_operation, "rpc": rpc_operation, "grpc": rpc_operation, "messaging": messaging_operation, "queue": messaging_operation}
    if kind in known:
        return known[kind](operation)
    opens = "^(?:" + "|".join(w for _, words in RPC for w in words) + ")"
    by_prefix = F.when(F.rlike(col(operation), F.lit(opens)), rpc_operation(operation)).otherwise("other")
    return first_match(F.upper(F.trim(F.coalesce(col(operation), F.lit("")))), _sql_rules(("read", "write", "ddl")), by_prefix)
