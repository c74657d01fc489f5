"""Character classes spelled out, so that every regular-expression engine reads them alike."""

#: Fixed value: what Unicode-aware string functions (split, strip) treat as white space.
WS = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Line ends of str.splitlines() that are left once control characters are gone.
EOL = "\\n\\x85\\u2028\\u2029"


def re2(pattern: str) -> str:
    """The same class in RE2 syntax (\\uXXXX is \\x{XXXX} there)."""
    import re

    return re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", pattern)
