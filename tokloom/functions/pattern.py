"""Fixed values the tokenizer format depends on, plus the pre-token pattern.

These constants must equal the reference tokenizer's for identical ids.
"""

from __future__ import annotations

# ---- fixed values (must match the reference tokenizer format) ----------------
SPECIAL_TOKENS = {
    "<HUMAN>": 32000,
    "<GPT>": 32001,
    "<|endoftext|>": 32002,
}
DEFAULT_VOCAB_SIZE = 32000
BASE_BYTES = 256
END_MARKER = "\n<|endoftext|>\n\n"          # appended after the last turn of a chat
TRAIN_MAX_BYTES = 50 * 1024 * 1024           # training byte budget of the reference
# ------------------------------------------------------------------------------

# Python's str ``\w`` is every letter and number category plus '_' and its ``\s``
# is the class below; Java's plain ``\w``/``\s`` are ASCII-only, so both are
# spelled out. The same text compiles in java.util.regex and in RE2 (DuckDB).
WORD_CLASS = r"\p{L}\p{N}_"
SPACE_CLASS = (r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
               r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")


_META = set("\\.^$|?*+()[]{}")


def _escape(tok: str) -> str:
    return "".join("\\" + c if c in _META else c for c in tok)


def special_alternation(specials: dict[str, int] | None = None) -> str:
    toks = list((specials or SPECIAL_TOKENS).keys())
    return "|".join(_escape(t) for t in toks)


def pretoken_pattern(specials: dict[str, int] | None = None) -> str:
    """Specials first, then word runs, whitespace runs, any other single char."""
    return (f"{special_alternation(specials)}|[{WORD_CLASS}]+|[{SPACE_CLASS}]+"
            f"|[^{WORD_CLASS}{SPACE_CLASS}]")


PRETOKEN_PATTERN = pretoken_pattern()

# Whitespace-only test (Python ``str.strip()`` empties the string).
NON_SPACE_PATTERN = f"[^{SPACE_CLASS}]"
