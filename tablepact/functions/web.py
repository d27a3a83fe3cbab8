"""Expressions over captured HTTP traffic: URL templates and JSON shapes."""

from __future__ import annotations

from .sql import array, bind, lit, pattern

# Host parts that mark analytics, ads, fonts and payment widgets.
NOISE_HOSTS = (
    "google", "gstatic", "sentry", "segment", "intercom", "hotjar", "posthog", "mixpanel", "clarity",
    "doubleclick", "facebook", "fonts.", "cloudflareinsights", "stripe", "hubspot", "linkedin",
)
# Request headers that carry credentials (names are reported, never values).
AUTH_HEADERS = ("authorization", "cookie", "x-access-token", "x-api-key", "x-auth-token")
# Fixed value: number, UUID, 24-digit hex id, or a token of at least 20 characters.
_ID_SEGMENT = (
    r"^(\d+|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|[0-9a-f]{24}|[A-Za-z0-9_-]{20,})$"
)
_MAX_KEYS = 8
_MAX_NESTING = 4


def url_host(url: str) -> str:
    """Lenient: whatever stands between ``//`` and the next slash, also beside characters that no URL may hold."""
    return f"regexp_extract({url}, {pattern('^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)')}, 1)"


def url_path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, {pattern('^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)')}, 1), '')"


def path_template(path: str) -> str:
    """Replace id-like path segments by ``{id}``."""
    return f"array_join(transform(split({path}, '/'), s -> if(s RLIKE {pattern(_ID_SEGMENT)}, '{{id}}', s)), '/')"


def is_noise_host(host: str) -> str:
    """The host contains one of the noise parts."""
    hosts = "|".join(h.replace(".", r"\.") for h in NOISE_HOSTS)
    return f"coalesce({host} RLIKE {pattern(hosts)}, false)"


def auth_headers(header_names: str) -> str:
    """Credential headers among the request's (lower-case) header names."""
    return f"array_intersect({array(lit(h) for h in AUTH_HEADERS)}, {header_names})"


def json_shape(text: str) -> str:
    """Top-level shape: ``{a, b}``, ``[3 × {a}]``, a scalar type name, ``(non-JSON)`` or empty."""
    return _shape(text, _MAX_NESTING)


def _shape(text: str, depth: int) -> str:
    t, v = f"t{depth}", f"v{depth}"
    keys = f"json_object_keys({t})"
    obj = (
        f"concat('{{', array_join(slice({keys}, 1, {_MAX_KEYS}), ', '), if(size({keys}) > {_MAX_KEYS}, '…', ''), '}}')"
    )
    if depth:
        # get_json_object keeps the key order but unquotes strings, hence the type test.
        inner = (
            f"CASE WHEN schema_of_variant(variant_get({v}, '$[0]', 'variant')) = 'STRING' THEN 'str' "
            f"WHEN trim({t}) RLIKE {pattern(r'^\[ *null')} THEN 'NoneType' "
            f"ELSE coalesce({_shape(f'get_json_object({t}, {lit("$[0]")})', depth - 1)}, '') END"
        )
    else:
        inner = "'…'"
    body = (
        f"CASE WHEN coalesce({t}, '') = '' THEN '' WHEN {v} IS NULL THEN '(non-JSON)' "
        f"WHEN startswith(trim({t}), '{{') THEN {obj} "
        f"WHEN startswith(trim({t}), '[') THEN concat('[', CAST(json_array_length({t}) AS STRING), ' × ', {inner}, ']') "
        f"WHEN startswith(trim({t}), '\"') THEN 'str' WHEN trim({t}) IN ('true', 'false') THEN 'bool' "
        f"WHEN trim({t}) = 'null' THEN 'NoneType' WHEN {t} RLIKE '[.eE]' THEN 'float' ELSE 'int' END"
    )
    return bind(text, t, bind(f"try_parse_json({t})", v, body))
