"""Prompt and chat formatting over conversation turns."""

from pyspark.sql import functions as F

from textloom.functions import templates as tp
from textloom.functions.text import between_markers, word_count, words
from textloom.operators import prompts
from textloom.plans import sqltext as q
from textloom.plans.registry import query


def _lit(template):
    """A template as an SQL expression over the given slots."""
    return [("'" + piece.replace("'", "''").replace("\n", "' || chr(10) || '") + "'") for piece in template.split("{}")]


def _fill(template, *slots):
    pieces = _lit(template)
    out = pieces[0]
    for slot, piece in zip(slots, pieces[1:]):
        out += f" || {slot} || {piece}"
    return out


_INST = f"WITH {q.INSTRUCTIONS} SELECT conv_id, pair_turn, "


def _instructions(t):
    return prompts.instruction_rows(t.conversations)


def _show(df, column):
    return df.select("conv_id", "pair_turn", column.alias("text"))


@query("c1_alpaca", _INST + _fill(tp.ALPACA, "instruction", "input", "output") + " || '</s>' AS text FROM instructions")
def alpaca(t):
    return _show(_instructions(t), tp.alpaca(F.col("instruction"), F.col("input"), F.col("output")))


@query(
    "c2_two_branch",
    _INST
    + f"CASE WHEN trim(input) = '' THEN {_fill(tp.ALPACA_NO_INPUT, 'instruction', 'output')} ELSE {_fill(tp.ALPACA, 'instruction', 'input', 'output')} END AS text FROM instructions",
)
def two_branch(t):
    return _show(_instructions(t), tp.two_branch(F.col("instruction"), F.col("input"), F.col("output")))


@query(
    "c2_two_branch_compat",
    _INST
    + f"""CASE WHEN trim(input) <> '' THEN {_fill(tp.ALPACA_NO_INPUT, 'instruction', 'output')}
              ELSE {_fill(tp.ALPACA, "instruction || ' '", 'input', 'output')} END AS text FROM instructions""",
)
def two_branch_compat(t):
    return _show(_instructions(t), tp.two_branch(F.col("instruction"), F.col("input"), F.col("output"), reference_compat=True))


_CONTEXT = f"CASE WHEN input = '' THEN '' ELSE {_fill(tp.CONTEXT, 'instruction', 'input', 'output')} END"


@query("c3_context_template", _INST + _CONTEXT + " AS text FROM instructions")
def context_template(t):
    return _show(_instructions(t), tp.with_context(F.col("instruction"), F.col("input"), F.col("output")))


@query("f3_drop_empty_text", f"SELECT * FROM ({_INST + _CONTEXT} AS text FROM instructions) WHERE text <> ''")
def drop_empty_text(t):
    return context_template(t).filter("text <> ''")


@query(
    "c4_instruct_reformat",
    _INST + _fill(tp.FENCED, r"trim(instruction, E' \t\n\r')", r"trim(output, E' \t\n\r')") + " AS text FROM instructions",
)
def instruct_reformat(t):
    """The marked prompt is written, cut apart at its markers, and written anew."""
    marked = tp.fill("### Instruction:\n{}\n### Output:\n{}", F.col("instruction"), F.col("output"))
    instruction = between_markers(marked, "### Instruction:", "### Output:")
    return _show(_instructions(t), tp.fill(tp.FENCED, instruction, between_markers(marked, "### Output:", None)))


@query("c5_prompt_completion", _INST + "'Prompt: ' || instruction || ' Completion: ' || output AS text FROM instructions")
def prompt_completion(t):
    return _show(_instructions(t), tp.fill("Prompt: {} Completion: {}", F.col("instruction"), F.col("output")))


@query(
    "c6_chatml",
    f"SELECT conv_id, turn, CASE WHEN text = '' THEN '' ELSE {_fill(tp.CHATML_TURN, 'role', 'text')} END AS rendered FROM conversations",
)
def chatml(t):
    """One rendered row per turn: a conversation's prompt is its rows in turn order.

    Rendering is row-local, however long a conversation is.
    """
    return t.conversations.select("conv_id", "turn", tp.chatml_turn(F.col("role"), F.col("text")).alias("rendered"))


@query(
    "c7_inst_chat",
    """SELECT conv_id, turn, CASE role WHEN 'user' THEN '<s>[INST] ' || trim(text) || ' [/INST]'
              WHEN 'system' THEN '<<SYS>>' || chr(10) || trim(text) || chr(10) || '<</SYS>>' || chr(10) || chr(10)
              WHEN 'assistant' THEN ' ' || text || ' </s>' END AS rendered FROM conversations""",
)
def inst_chat(t):
    return t.conversations.select("conv_id", "turn", tp.inst_turn(F.col("role"), F.col("text")).alias("rendered"))


@query(
    "c8_history_messages",
    f"""WITH {q.PAIRS} SELECT conv_id, pair_turn AS turn, 'user' AS role, question AS content FROM pairs WHERE question <> ''
        UNION ALL SELECT conv_id, pair_turn + 1, 'assistant', answer FROM pairs WHERE answer <> ''""",
)
def history_messages(t):
    return prompts.history_messages(prompts.turn_pairs(t.conversations))


def _preferences(t):
    """Chosen: the own answer.  Rejected: the next conversation's answer at the same place."""
    rows = _instructions(t)
    other = rows.select((F.col("conv_id") - 1).alias("conv_id"), "pair_turn", F.col("output").alias("rejected"))
    return rows.join(other, ["conv_id", "pair_turn"]).select(
        "conv_id",
        "pair_turn",
        F.col("input").alias("system"),
        F.col("instruction").alias("question"),
        F.col("output").alias("chosen"),
        "rejected",
    )


_PREFERENCES = f"""WITH {q.INSTRUCTIONS},
    pref AS (SELECT a.conv_id, a.pair_turn, a.input AS system, a.instruction AS question, a.output AS chosen, b.output AS rejected
             FROM instructions a JOIN instructions b ON b.conv_id = a.conv_id + 1 AND b.pair_turn = a.pair_turn)"""


@query(
    "c9_preference_format",
    _PREFERENCES
    + f""" SELECT conv_id, pair_turn, CASE WHEN system = '' THEN '' ELSE {_fill(tp.CHATML_TURN, "'system'", 'system')} END
            || {_fill(tp.CHATML_TURN, "'user'", 'question')} || '<|im_start|>assistant' || chr(10) AS prompt,
            chosen || chr(10) AS chosen, rejected || chr(10) AS rejected,
            {_fill(tp.ALPACA, 'question', 'system', "''")} AS flat_prompt, chosen || '</s>' AS flat_chosen FROM pref""",
)
def preference_format(t):
    rows = prompts.project(_preferences(t), ["conv_id", "pair_turn", "system", "question", "chosen", "rejected"])
    prompt = F.concat(
        tp.chatml_turn(F.lit("system"), F.col("system")),
        tp.chatml_turn(F.lit("user"), F.col("question")),
        F.lit("<|im_start|>assistant\n"),
    )
    return rows.select(
        "conv_id",
        "pair_turn",
        prompt.alias("prompt"),
        F.concat("chosen", F.lit("\n")).alias("chosen"),
        F.concat("rejected", F.lit("\n")).alias("rejected"),
        tp.fill(tp.ALPACA, F.col("question"), F.col("system"), F.lit("")).alias("flat_prompt"),
        F.concat("chosen", F.lit("</s>")).alias("flat_chosen"),
    )


@query("c10_preference_projection", _PREFERENCES + " SELECT question AS prompt, chosen, rejected FROM pref")
def preference_projection(t):
    return prompts.project(_preferences(t).withColumnRenamed("question", "prompt"), ["prompt", "chosen", "rejected"])


SYSTEM = "You are a helpful assistant."
CONTEXT_WORDS, ANSWER_WORDS = 400, 100
_FIXED_WORDS = len(tp.system_prompt(SYSTEM, "", "").split())


@query(
    "c11_budgeted_prompt",
    f"""WITH {q.PAIRS},
    o AS (SELECT conv_id, text AS instruction, {CONTEXT_WORDS - ANSWER_WORDS - _FIXED_WORDS} - {q.word_count('text')} AS room FROM (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS i FROM conversations) WHERE i = 1 AND role = 'user'),
    e AS (SELECT p.conv_id, pair_turn, room, '### User:' || question || '</s>' AS eq, '### Assistant:' || answer || '</s>' AS ea FROM pairs p JOIN o USING (conv_id)),
    u AS (SELECT *, eq || ea AS entry, sum({q.word_count('eq')} + {q.word_count('ea')}) OVER (PARTITION BY conv_id ORDER BY pair_turn DESC) AS used FROM e),
    h AS (SELECT conv_id, string_agg(entry, '' ORDER BY pair_turn) AS history FROM u WHERE used <= room GROUP BY conv_id)
    SELECT o.conv_id, '### System Prompt:' || chr(10) || '{SYSTEM}' || chr(10) || chr(10) || coalesce(history, '') || chr(10) || chr(10)
           || '### User Message: ' || instruction || chr(10) || chr(10) || '### Assistant:' AS prompt
    FROM o LEFT JOIN h USING (conv_id)""",
)
def budgeted_prompt(t):
    return prompts.budgeted_prompt(t.conversations, SYSTEM, CONTEXT_WORDS, ANSWER_WORDS)


_QUESTION = "Question: Which part opens the text?"


def _quiz_part(i: int) -> str:
    """The i-th quarter of the words, from 0."""
    return f"array_to_string(w[len(w) * {i} // 4 + 1 : len(w) * {i + 1} // 4], ' ')"


@query(
    "c12_quiz_prompt",
    f"""WITH w AS (SELECT item_id, {q.words('text')} AS w FROM benchmark),
    o AS (SELECT item_id, item_id % 4 AS turn, [{', '.join(_quiz_part(i) for i in range(4))}] AS o FROM w),
    p AS (SELECT item_id, {_fill(tp.QUIZ, f"'{_QUESTION}'", *[f"o[({i} - turn + 4) % 4 + 1]" for i in range(4)])} AS prompt,
                 substr('ABCD', turn + 1, 1) AS answer FROM o),
    e AS (SELECT prompt || ' ' || answer AS example, item_id, row_number() OVER (ORDER BY item_id) AS i FROM p)
    SELECT p.item_id, prompt, answer, example || prompt AS one_shot FROM p JOIN e
    ON (e.i = 1 AND e.item_id <> p.item_id) OR (e.i = 2 AND p.item_id = (SELECT min(item_id) FROM p))""",
)
def quiz_prompt(t):
    """The four quarters of a text are the options; the first item, with its answer, is the example of all others, the second its own."""
    w = words(F.col("text"))
    cut = lambda i: F.floor(F.size("w") * i / 4).cast("int")
    quarters = F.array(*[F.array_join(F.slice("w", cut(i) + 1, cut(i + 1) - cut(i)), " ") for i in range(4)])
    items = t.benchmark.select("item_id", w.alias("w")).select("item_id", (F.col("item_id") % 4).alias("turn"), quarters.alias("o"))
    options = [F.get("o", ((F.lit(i) - F.col("turn") + 4) % 4).cast("int")) for i in range(4)]
    answer = F.substring(F.lit("ABCD"), (F.col("turn") + 1).cast("int"), F.lit(1))
    asked = items.select("item_id", tp.fill(tp.QUIZ, F.lit(_QUESTION), *options).alias("prompt"), answer.alias("answer"))
    return prompts.one_shot(asked, "item_id", "prompt", "answer", "one_shot")


@query(
    "c13_named_template",
    "SELECT doc_id, replace('Please answer: {question}', '{question}', lang) AS prompt, text || chr(10) || 'TL;DR:' || chr(10) AS summary_prompt FROM documents",
)
def named_template(t):
    return t.documents.select(
        "doc_id",
        tp.fill_named("Please answer: {question}", question=F.col("lang")).alias("prompt"),
        F.concat("text", F.lit("\nTL;DR:\n")).alias("summary_prompt"),
    )


@query(
    "c14_long_document_prompt",
    f"""SELECT doc_id, {q.word_count('prompt')}::INTEGER AS n_words, prompt FROM (
          SELECT doc_id, {_fill(tp.LONG_DOCUMENT, 'text')} AS prompt FROM documents) WHERE {q.word_count('prompt')} <= 8192""",
)
def long_document_prompt(t):
    """Documents that do not fit the context are left out, as a whole."""
    prompt = tp.fill(tp.LONG_DOCUMENT, F.col("text"))
    rows = t.documents.select("doc_id", prompt.alias("prompt"))
    return rows.select("doc_id", word_count(F.col("prompt")).alias("n_words"), "prompt").filter("n_words <= 8192")


@query("c15_text_column", "SELECT html AS text FROM pages")
def text_column(t):
    return prompts.project(t.pages, ["html"]).select(F.col("html").alias("text"))
