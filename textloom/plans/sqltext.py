"""SQL fragments shared by the oracle queries."""

from textloom.functions.text import SPACE, WORD


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '{WORD}')"


def word_count(x: str) -> str:
    return f"len({words(x)})"


def hash_key(x: str, seed: int, bits: int = 28) -> str:
    return f"('0x' || substr(md5('{seed}:' || {x}), 1, {bits // 4}))::BIGINT"


def strip(x: str, pattern: str, replacement: str = "") -> str:
    replacement = replacement.replace("'", "''")
    return f"regexp_replace({x}, '{pattern}', '{replacement}', 'g')"


def sentences(x: str) -> str:
    return f"string_split(regexp_replace({x}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"


def csv(x: str) -> str:
    return f"array_to_string({x}, ',')"


def r(x: str, digits: int = 6) -> str:
    """Rounded, with negative zero made plain zero."""
    return f"(round({x}, {digits}) + 0.0::DOUBLE)"


# One row per (user turn, assistant turn) pair of a conversation.
PAIRS = """
pairs AS (
  SELECT conv_id, turn AS pair_turn, text AS question, answer FROM (
    SELECT conv_id, turn, role, text,
           lead(role) OVER w AS next_role, lead(text) OVER w AS answer
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
  ) WHERE role = 'user' AND next_role = 'assistant'
)"""

# Instruction, input (system text or '') and output.
INSTRUCTIONS = (
    PAIRS
    + """,
instructions AS (
  SELECT p.conv_id, p.pair_turn, question AS instruction, coalesce(s.text, '') AS input, answer AS output
  FROM pairs p LEFT JOIN conversations s ON s.conv_id = p.conv_id AND s.role = 'system'
)"""
)

__all__ = ["SPACE", "WORD"]
