"""Regex dialect helper.

The rule patterns are written in Python ``re`` syntax, where ``\\b``, ``\\w``,
``\\s`` and ``.`` are Unicode-aware.  Spark (java.util.regex) and DuckDB (RE2)
disagree with Python and with each other on exactly those four tokens
(``\\b`` next to accented letters, ``.`` and ``\\r``, ``\\s`` and ``\\x0B``).
``portable`` rewrites them into explicit classes that both engines read the
same way and that follow Python's meaning:

* ``\\w``  -> ``[\\p{L}\\p{N}_]``
* ``\\s``  -> the Unicode whitespace class below
* ``.``   -> ``[^\\n]``
* ``\\b``  -> a consuming boundary: ``(?:^|[^\\p{L}\\p{N}_])`` at the start of
  the pattern, ``(?:[^\\p{L}\\p{N}_]|$)`` elsewhere.  All patterns here are
  used for *contains* tests, where a consuming boundary is equivalent.

Patterns are matched against ``lower(text)``, so no case flag is needed.
"""

from __future__ import annotations

WORD_CLASS_BODY = r"\p{L}\p{N}_"
SPACE_CLASS_BODY = r"\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}"
WORD = f"[{WORD_CLASS_BODY}]"
SPACE = f"[{SPACE_CLASS_BODY}]"
LEAD_BOUNDARY = f"(?:^|[^{WORD_CLASS_BODY}])"
TRAIL_BOUNDARY = f"(?:[^{WORD_CLASS_BODY}]|$)"
# Leading / trailing Unicode whitespace (Python str.strip semantics).
TRIM_PATTERN = f"^{SPACE}+|{SPACE}+$"
# The characters of that class one by one, for functions that take no pattern.
SPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# Tokens for the polarity scorer and phrase miner.
LEXICON_TOKEN = r"[\p{L}\p{N}_']+"
PHRASE_TOKEN = r"[\p{L}\p{N}_]{2,}"


def portable(pattern: str) -> str:
    """Rewrite a Python-syntax pattern for identical Java / RE2 behaviour."""
    out: list[str] = []
    i, n, in_class = 0, len(pattern), False
    while i < n:
        ch = pattern[i]
        if ch == "\\" and i + 1 < n:
            nxt = pattern[i + 1]
            if nxt == "w":
                out.append(WORD_CLASS_BODY if in_class else WORD)
            elif nxt == "s":
                out.append(SPACE_CLASS_BODY if in_class else SPACE)
            elif nxt == "b" and not in_class:
                if i and i + 2 < n and pattern[i + 2] not in "|)":
                    raise ValueError(f"\\b inside {pattern!r}: only at the start or an alternative's end can it be rewritten")
                out.append(LEAD_BOUNDARY if i == 0 else TRAIL_BOUNDARY)
            else:
                out.append(pattern[i : i + 2])
            i += 2
            continue
        if in_class:
            if ch == "]":
                in_class = False
            out.append(ch)
        elif ch == "[":
            in_class = True
            out.append(ch)
            # a leading ']' or '^]' is literal inside a class
            if i + 1 < n and pattern[i + 1] == "^":
                out.append("^")
                i += 1
        elif ch == ".":
            out.append(r"[^\n]")
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def sql_str(s: str) -> str:
    """Quote a Python string as a standard SQL literal (DuckDB)."""
    return "'" + s.replace("'", "''") + "'"


def escape_literal(s: str) -> str:
    """Escape regex metacharacters so ``s`` matches literally in Java and RE2."""
    return "".join("\\" + c if c in r"\^$.|?*+()[]{}" else c for c in s)
