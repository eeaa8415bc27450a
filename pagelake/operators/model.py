"""The recognition model as a Spark stage: pluggable clients, retries, routing, error records.

A client is made once per partition by a factory, which is given the stage's policy (model, temperature and token limit
are in it), and answers requests with a text, or with an Answer that also says why the model stopped; it may raise. What
is asked for is a table, what comes back is a table, and every failure is a row.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions import text as T

# The next lower thinking level.
LOWER = {"high": "medium", "medium": "low", "low": "low"}
# Full-page modes with their media resolution.
FULL_PAGE = {"table": "high", "graph": "ultra_high", "map": "high"}
# Names of the scripts in prompts.
SCRIPTS = {"kurrent": "German Kurrent (Kurrentschrift)", "latin": "Latin cursive", "mixed": "mixed Kurrent and Latin cursive"}

PROMPTS = {
    "detect": "List the layout regions of this page as JSON: {{\"regions\": [...]}}, at most {max_regions}. Each has id, type, reading_order and bbox with integer x, y, width, height on a 0-1000 grid from the top left. Regions do not overlap; a table is one region.",
    "table": "Transcribe the table to HTML: thead of {header_rows} row(s), {data_rows} data rows, {cols} columns. Red ink: {has_red_ink}; totals row: {has_totals_row}. Copy every cell as written, leave empty cells empty, mark red ink with <span class=\"red\">, doubtful letters with [?] and unreadable words with [illegible].",
    "graph": "Describe the chart in sections: Graph Type, Axes, Data Points (a pipe table), Fitted Curve / Lines, Additional Notes.",
    "title": "Transcribe the heading in one line, as written.",
    "text": "Transcribe this {region_type} written in {script}, line by line, without changing the spelling.",
    "full_table": "Transcribe the page: the table as HTML in an html fence, all other text around it as Markdown.",
    "full_graph": "Transcribe the page's chart: Calibration and Axes, Title / Heading, Tabulated Heights & Point Labels, Scatter Data Points (one decimal, between two grid lines), Fitted Curve, Notes.",
    "full_map": "Transcribe the map: Map Type, Map Title, Geographic Identification (Geoident), Scale, Date, Compass / Orientation, Transcribed Text, Notes.",
}


def next_level(stage: str, level: str) -> str:
    """The thinking level after an empty answer; transcription leaves `minimal` as it is, detection does not know it."""
    if stage == "transcribe" and level == "minimal":
        return level
    return LOWER.get(level, "medium")


@dataclass(frozen=True)
class Answer:
    """A text and the reason for which the model stopped."""

    text: str
    finish_reason: str = ""


@dataclass
class Policy:
    """What a stage asks with, and how it retries: on empty answers at a lower level, on bad JSON as before, on exceptions
    only in transcription."""

    stage: str
    level: str = "high"
    resolution: str = "high"
    retries: int = 2
    pause: float = 1.5
    model_id: str = "stub"
    temperature: float = 1.0
    max_output_tokens: int = 65_536


@dataclass(frozen=True)
class State:
    """Where a call stands: its status (open, success, error), what the next attempt is made with, the attempts so far, the
    pauses so far and the one before the next attempt, in seconds."""

    status: str
    level: str
    resolution: str
    tries: int = 0
    pause: float = 0.0
    wait: float = 0.0


OUTCOMES = ("success", "empty", "exception", "bad_json")


def opened(policy: Policy) -> State:
    return State("open", policy.level, policy.resolution)


def advance(policy: Policy, state: State, outcome: str) -> State:
    """The state of an open call after one more attempt; the one machine of runs, streams and tables.

    An empty answer lowers the level, in transcription the last retry after one is at the finest resolution; an exception
    pauses, longer each time, or ends detection; bad JSON is asked for again as before.
    """
    tries = state.tries + 1
    if outcome == "success":
        return replace(state, status="success", tries=tries, wait=0.0)
    if tries > policy.retries or (outcome == "exception" and policy.stage == "detect"):
        return replace(state, status="error", tries=tries, wait=0.0)
    level, resolution = state.level, state.resolution
    if outcome == "empty":
        level = next_level(policy.stage, level)
        if policy.stage == "transcribe" and tries == policy.retries and resolution and not resolution.endswith("ultra_high"):
            resolution = "ultra_high"
    wait = policy.pause * tries if outcome == "exception" else 0.0
    return State("open", level, resolution, tries, state.pause + wait, wait)


def call(ask: Callable[[str, str, str], str | Answer], policy: Policy, prompt: str, parse: Callable[[str], object] | None = None, sleep: Callable[[float], None] = time.sleep) -> dict:
    """One request with its retries: status, text, error, the last finish reason and the attempts made as (outcome, level,
    resolution).

    An answer whose JSON does not parse at the last attempt is the text of the error; an empty one's error names the
    finish reason.
    """
    state, error, made, raw, reason = opened(policy), "", [], "", None
    while state.status == "open" and (policy.retries >= 0 or policy.stage != "detect"):
        text, raw = "", ""
        try:
            answer = ask(prompt, state.level, state.resolution)
            text, reason = (answer.text, answer.finish_reason or None) if isinstance(answer, Answer) else (answer, None)
            outcome = "success" if text else "empty"
            error = "" if text else f"empty response (finish reason: {reason or 'unknown'})"
            if text and parse:
                parse(text)
        except ValueError as e:
            outcome, error, raw = ("bad_json", f"JSON parse: {e}", text) if text else ("exception", str(e), "")
        except Exception as e:
            outcome, error = "exception", str(e)
        made.append((outcome, state.level, state.resolution))
        state = advance(policy, state, outcome)
        if state.wait:
            sleep(state.wait)
    if state.status == "success":
        return {"status": "success", "text": text.strip(), "error": None, "finish_reason": reason, "attempts": made}
    return {"status": "error", "text": raw, "error": error, "finish_reason": reason, "attempts": made}


RESULT = "status string, text string, error string, finish_reason string, attempts array<struct<outcome:string,level:string,resolution:string>>"


def ask_model(requests: DataFrame, client: Callable[[Policy], Callable[[str, str, str, bytes], str | Answer]], policy: Policy, keys: list[str], parse: Callable[[str], object] | None = None) -> DataFrame:
    """requests(keys, prompt, pixels) with each row's result; one client per partition, made on the executor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = client(policy)
        for batch in batches:
            out = []
            for prompt, pixels in zip(batch["prompt"], batch["pixels"], strict=True):
                out.append(call(lambda p, level, res, data=pixels: answer(p, level, res, data), policy, prompt, parse))
            yield pd.concat([batch[keys].reset_index(drop=True), pd.DataFrame(out, columns=["status", "text", "error", "finish_reason", "attempts"])], axis=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema if f.name in keys) + ", " + RESULT
    return requests.select(*keys, "prompt", "pixels").mapInPandas(run, schema)


def full_page(kind: str) -> tuple[str, str]:
    """The prompt and the media resolution of a full-page mode; ValueError for any other."""
    if kind not in FULL_PAGE:
        raise ValueError(f"no full-page mode {kind!r}; one of {', '.join(FULL_PAGE)}")
    return PROMPTS[f"full_{kind}"], FULL_PAGE[kind]


def stub_client(policy: Policy) -> Callable[[str, str, str, bytes], str]:
    """A client without a model, for trying a run out: answers with the prompt's length."""
    return lambda prompt, level, resolution, pixels: f"{len(prompt)} {level} {resolution}"


def route_regions(regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(without a call, for the model): page numbers are transcribed already."""
    number = F.when(F.col("page_number").isNull(), "None").otherwise(F.col("page_number"))
    # A missing key is an empty text, a null value is not.
    text = F.when(F.array_contains("present", "page_number"), number).otherwise("")
    known = regions.where("type = 'PageNumberRegion'").select("*", F.lit("success").alias("status"), text.alias("text"), F.lit(True).alias("skipped"))
    return known, regions.where("type <> 'PageNumberRegion'")


def prompt_parameters(regions: DataFrame) -> DataFrame:
    """regions with the kind of prompt and what is filled in."""
    kind = F.when(F.col("type") == "TableRegion", "table").when(F.col("type") == "GraphRegion", "graph").when(F.col("type") == "TitleRegion", "title").otherwise("text")
    yes = lambda c: F.when(F.coalesce(F.col(c), F.lit(False)), "yes").otherwise("no")
    header = F.coalesce("header_rows", F.lit(1))
    data = F.when(F.col("rows").isNull(), "?").otherwise(F.greatest(F.lit(0), F.col("rows") - header).cast("string"))
    return regions.select("*", kind.alias("kind"), header.cast("string").alias("p_header_rows"), data.alias("p_data_rows"), F.coalesce(F.col("cols").cast("string"), F.lit("?")).alias("p_cols"), yes("has_red_ink").alias("p_red"), yes("has_totals_row").alias("p_totals"), T.lookup(SCRIPTS, F.coalesce("script", F.lit("kurrent")), "German Kurrent").alias("p_script"))


def prompts(regions: DataFrame) -> DataFrame:
    """regions with their prompt as text."""
    p = prompt_parameters(regions)
    filled = {
        "table": [("{header_rows}", "p_header_rows"), ("{data_rows}", "p_data_rows"), ("{cols}", "p_cols"), ("{has_red_ink}", "p_red"), ("{has_totals_row}", "p_totals")],
        "graph": [],
        "title": [],
        "text": [("{region_type}", "type"), ("{script}", "p_script")],
    }
    out: Column | None = None
    for kind, names in filled.items():
        text = F.lit(PROMPTS[kind])
        for mark, name in names:
            text = F.replace(text, F.lit(mark), F.col(name))
        out = F.when(F.col("kind") == kind, text) if out is None else out.when(F.col("kind") == kind, text)
    return p.withColumn("prompt", out)


def transitions(policy: Policy) -> dict[tuple[State, str], State]:
    """Every step that an open call can make."""
    out: dict[tuple[State, str], State] = {}
    todo = [opened(policy)]
    while todo:
        state = todo.pop()
        for outcome in OUTCOMES:
            if (state, outcome) not in out:
                out[state, outcome] = after = advance(policy, state, outcome)
                todo += [after] if after.status == "open" else []
    return out


def replay(attempts: DataFrame, stage: str, key: str = "call_id", retries: int = 2, level: str = "high", resolution: str = "high") -> DataFrame:
    """The state of each call after its attempts(key, attempt, outcome), in order: status, level, resolution, tries, pause.

    The steps of advance(), as a table that the attempts are folded over; attempts after the end count for nothing.
    """
    policy = Policy(stage, level, resolution, retries)
    steps = transitions(policy)
    states = list(dict.fromkeys([opened(policy), *(s for s, _ in steps), *steps.values()]))
    number = {s: i for i, s in enumerate(states)}
    table = F.create_map(*[F.lit(x) for (s, o), after in steps.items() for x in (f"{number[s]} {o}", number[after])])
    shown = F.array(*[F.struct(F.lit(s.status).alias("status"), F.lit(s.level).alias("level"), F.lit(s.resolution).alias("resolution"), F.lit(s.tries).alias("tries"), F.lit(s.pause).alias("pause")) for s in states])
    tries = F.array_sort(F.collect_list(F.struct("attempt", "outcome")))
    end = F.aggregate(tries, F.lit(0), lambda at, x: F.coalesce(F.try_element_at(table, F.concat_ws(" ", at.cast("string"), x["outcome"])), at))
    return attempts.groupBy(key).agg(end.alias("at")).select(key, F.get(shown, F.col("at")).alias("s")).select(key, "s.*")


def answer_text(text: Column, candidates: Column) -> Column:
    """The answer's own text, else the first candidate's parts that make up any, else ''."""
    joined = F.filter(F.transform(candidates, lambda c: F.array_join(c, "")), lambda s: s != "")
    return F.coalesce(F.nullif(text, F.lit("")), F.get(joined, 0), F.lit(""))


def dumped(text: Column) -> Column:
    """An answer for the log: its first 800 characters."""
    return F.when(F.length(text) > 800, F.concat(F.left(text, F.lit(800)), F.lit("…[truncated]"))).otherwise(text)
