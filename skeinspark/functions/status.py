"""Status codes as classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import col, first_match

# Classes of gRPC codes 0 to 16, and of words in a status text, in order.
GRPC = ("success", "client_error", "server_error", "client_error", "server_error", "client_error", "client_error", "client_error", "server_error", "client_error", "client_error", "client_error", "server_error", "server_error", "server_error", "server_error", "client_error")
TEXT_RULES = (
    (r"\b(ok|success|200|2\d\d)\b", "success"),
    (r"\b(err|fail|exception|error)\b", "server_error"),
    (r"\b(not.?found|unauthorized|forbidden|4\d\d)\b", "client_error"),
    (r"\b(5\d\d|internal|unavailable)\b", "server_error"),
    (r"\b(redirect|3\d\d)\b", "redirect"),
)
HTTP_CLASSES = {1: "informational", 2: "success", 3: "redirect", 4: "client_error", 5: "server_error"}
CORE = ("success", "client_error", "server_error")


def number(status: Column | str) -> Column:
    return F.trim(col(status).cast("string")).try_cast("int")


def text_status(status: Column | str) -> Column:
    return F.when(col(status).isNull(), F.lit(None)).otherwise(first_match(F.lower(col(status).cast("string")), TEXT_RULES, "unknown"))


def _http(code: Column) -> Column:
    out = F
    for hundred, name in HTTP_CLASSES.items():
        out = out.when(code.between(100 * hundred, 100 * hundred + 99), name)
    return out.otherwise("unknown")


def _grpc(code: Column) -> Column:
    return F.coalesce(F.get(F.array(*map(F.lit, GRPC)), F.when(code >= 0, code).otherwise(len(GRPC))), F.lit("unknown"))


def http_status(status: Column | str) -> Column:
    """Class of an HTTP code; text by its words; null stays null."""
    n = number(status)
    return F.when(n.isNull(), text_status(status)).otherwise(_http(n))


def grpc_status(status: Column | str) -> Column:
    n = number(status)
    return F.when(n.isNull(), text_status(status)).otherwise(_grpc(n))


def status_bucket(status: Column | str, label: str | None = None) -> Column:
    """Class of a status; the label's name may say which kind of code it is, else numbers under 100 are gRPC codes."""
    if label and "grpc" in label.lower():
        return grpc_status(status)
    if label and "http" in label.lower():
        return http_status(status)
    n = number(status)
    return F.when(n.isNull(), text_status(status)).when(n >= 100, _http(n)).otherwise(_grpc(n))


def is_success(status: Column | str, label: str | None = None) -> Column:
    return status_bucket(status, label) == "success"


def is_error(status: Column | str, label: str | None = None) -> Column:
    return status_bucket(status, label).isin("client_error", "server_error")
