"""Shared SQL fragments for the DuckDB oracles (independent re-statements of
each operator's meaning in plain SQL; they never call into tokloom code)."""

from __future__ import annotations

NL = "chr(10)"

# Fixed values of the token format, spelled out here once more, so that a wrong
# one in the package shows: letters and digits, white space, and the three tags
# (32000, 32001, 32002).
LETTERS = r"\p{L}\p{N}_"
SPACES = (r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
          r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
TAGS = r"<HUMAN>|<GPT>|<\|endoftext\|>"
PRETOKEN_PATTERN = f"{TAGS}|[{LETTERS}]+|[{SPACES}]+|[^{LETTERS}{SPACES}]"
NON_SPACE_PATTERN = f"[^{SPACES}]"

# Chat blocks: turn segments concatenated in turn order plus the end marker.
BLOCKS_CTE = f"""
seg AS (
  SELECT conv_id, turn,
         '<' || upper(CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt'
                      ELSE role END) || '>' || {NL} || text || {NL} AS seg
  FROM conversations),
blocks AS (
  SELECT conv_id,
         string_agg(seg, '' ORDER BY turn) || {NL} || '<|endoftext|>' || {NL} || {NL} AS block
  FROM seg GROUP BY conv_id)"""

# Lines keep their newline; the trailing empty piece after the last newline is dropped.
LINES_CTE = BLOCKS_CTE + f""",
parts AS (
  SELECT conv_id, string_split(replace(replace(block, chr(13) || {NL}, {NL}), chr(13), {NL}),
                               {NL}) AS ps
  FROM blocks),
lines AS (
  SELECT conv_id, CAST(t.n - 1 AS INTEGER) AS line_no,
         CASE WHEN t.n < len(ps) THEN t.p || {NL} ELSE t.p END AS line
  FROM parts, unnest(ps) WITH ORDINALITY AS t(p, n)
  WHERE CASE WHEN t.n < len(ps) THEN t.p || {NL} ELSE t.p END <> '')"""

WORDS_CTE = LINES_CTE + f""",
words AS (
  SELECT conv_id, line_no, CAST(w.k - 1 AS INTEGER) AS word_no, w.word
  FROM lines, unnest(regexp_extract_all(line, '{PRETOKEN_PATTERN}')) WITH ORDINALITY AS w(word, k))"""


def with_(cte: str, body: str) -> str:
    return f"WITH {cte}\n{body}"


# ---- BPE in SQL ------------------------------------------------------------
# A symbol is written as four upper-case hex digits and a dot ("0061."), so a
# pair is ten characters and ``replace`` can only match on symbol boundaries.

def sym_of(word_expr: str) -> str:
    return f"regexp_replace(hex(encode({word_expr})), '(..)', '00\\1.', 'g')"


def sym_ids_csv(sym_expr: str) -> str:
    return (f"array_to_string(list_transform(range(0, len({sym_expr}) // 5), "
            f"lambda j: CAST(CAST(('0x' || substring({sym_expr}, 5 * j + 1, 4)) AS INTEGER) "
            f"AS VARCHAR)), ',')")


# Byte-level words: without a look-ahead, the last white space before other text is
# set off by a private-use mark, which is dropped from the matches.
_CUT, _MARK = "chr(57344)", "chr(57345)"
BYTE_LEVEL_WORD = (r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+"
                   rf"| ?[^{SPACES}\x{{E001}}\p{{L}}\p{{N}}]+|[{SPACES}]+|\x{{E001}}")


def byte_level_pieces(text: str) -> str:
    """The text cut before and after each tag; empty pieces stay."""
    return f"string_split(regexp_replace({text}, '({TAGS})', {_CUT} || '\\1' || {_CUT}, 'g'), {_CUT})"


def byte_level_words(piece: str) -> str:
    marked = f"regexp_replace({piece}, '([{SPACES}])([^{SPACES}])', {_MARK} || '\\1\\2', 'g')"
    return (f"list_filter(regexp_extract_all({marked}, '{BYTE_LEVEL_WORD}'), "
            f"lambda w: w <> {_MARK})")


BYTE_LEVEL_WORDS_CTE = LINES_CTE + f""",
pieces AS (
  SELECT conv_id, line_no, t.k, t.p FROM lines,
    unnest({byte_level_pieces('line')}) WITH ORDINALITY AS t(p, k)
  WHERE t.p NOT IN ('<HUMAN>', '<GPT>', '<|endoftext|>')),
words AS (
  SELECT conv_id, line_no, word, CAST(row_number() OVER (
      PARTITION BY conv_id, line_no ORDER BY k, j) - 1 AS INTEGER) AS word_no
  FROM (SELECT conv_id, line_no, pieces.k, w.j, w.word FROM pieces,
    unnest({byte_level_words('p')}) WITH ORDINALITY AS w(word, j)))"""


def bpe_ctes(k: int, words_cte: str = WORDS_CTE) -> str:
    """Strict BPE for ``k`` rounds as unrolled CTEs ``st0..stk``, ``best0..``, ``merges``."""
    out = [words_cte, f""",
freq AS (
  SELECT word, count(*) AS n, min({{'c': conv_id, 'l': line_no, 'w': word_no}}) AS fp
  FROM words GROUP BY word),
st0 AS (SELECT word, n, fp, {sym_of('word')} AS sym FROM freq)"""]
    for r in range(k):
        out.append(f""",
pr{r} AS (
  SELECT substring(sym, 5 * i + 1, 10) AS p, n, {{'fp': fp, 'i': i}} AS pk
  FROM st{r}, unnest(range(0, len(sym) // 5 - 1)) AS t(i)),
best{r} AS (
  SELECT p, CAST(sum(n) AS BIGINT) AS c, min(pk) AS fst FROM pr{r}
  GROUP BY p ORDER BY c DESC, fst LIMIT 1),
st{r + 1} AS (
  SELECT word, n, fp, replace(sym, (SELECT p FROM best{r}), printf('%04X.', {256 + r})) AS sym
  FROM st{r})""")
    if k == 0:
        return "".join(out)
    union = " UNION ALL ".join(
        f"SELECT {r} AS rank, p, c FROM best{r}" for r in range(k))
    out.append(f""",
merges AS (
  SELECT CAST(rank AS INTEGER) AS rank,
         CAST(('0x' || substring(p, 1, 4)) AS INTEGER) AS "left",
         CAST(('0x' || substring(p, 6, 4)) AS INTEGER) AS "right",
         CAST(256 + rank AS INTEGER) AS new_id, c
  FROM ({union}))""")
    return "".join(out)


def bpe_recursive(k: int, more_words: str = "") -> str:
    """Strict BPE for many rounds as one recursive CTE ``st``: the words of round ``r`` with the pair merged to get
    there. ``more_words`` is SQL of further words (word) that are merged along but not counted."""
    more = f" UNION ALL SELECT word, 0, NULL FROM ({more_words})" if more_words else ""
    return WORDS_CTE + f""",
counted AS (
  SELECT word, count(*) AS n, min({{'c': conv_id, 'l': line_no, 'w': word_no}}) AS fp FROM words GROUP BY word{more}),
freq AS (
  SELECT word, row_number() OVER (ORDER BY min(fp) NULLS LAST, word) AS wr, max(n) AS n, {sym_of('word')} AS sym
  FROM counted GROUP BY word),
st AS (
  SELECT 0 AS r, wr, n, sym, NULL::VARCHAR AS p, NULL::BIGINT AS c FROM freq WHERE len(sym) > 5
  UNION ALL
  SELECT st.r + 1, wr, n, replace(sym, best.p, printf('%04X.', 256 + st.r)), best.p, best.c
  FROM st, (SELECT substring(sym, 5 * i + 1, 10) AS p, CAST(sum(n) AS BIGINT) AS c
            FROM st, unnest(range(0, len(sym) // 5 - 1)) AS t(i) GROUP BY 1
            ORDER BY c DESC, min(CASE WHEN n > 0 THEN wr * 1000000 + i END) NULLS LAST LIMIT 1) best
  WHERE st.r < {k})"""


def encode_sym_expr(text_expr: str, k: int, words: str | None = None) -> str:
    """Encoded symbol string of a text: words joined by '|', merges 0..k-1 replaced."""
    words = words or f"regexp_extract_all({text_expr}, '{PRETOKEN_PATTERN}')"
    per_word = (f"list_transform({words}, lambda w: CASE w "
                f"WHEN '<HUMAN>' THEN printf('%04X.', 32000) "
                f"WHEN '<GPT>' THEN printf('%04X.', 32001) "
                f"WHEN '<|endoftext|>' THEN printf('%04X.', 32002) "
                f"ELSE {sym_of('w')} END)")
    s = f"array_to_string({per_word}, '|')"
    for r in range(k):
        s = f"replace({s}, (SELECT p FROM best{r}), printf('%04X.', {256 + r}))"
    return f"replace({s}, '|', '')"


FOLDED_BLOCK = f"replace(replace(block, chr(13) || {NL}, {NL}), chr(13), {NL})"
