"""Detection asks again when an answer's JSON does not parse."""

import json
import os

import pytest

from pagelake.config import RunConfig
from pagelake.functions import text
from pagelake.operators import images
from pagelake.plans import documents
from tests.test_runs import ANSWER, page


def client(bad):
    """One page: the first `bad` answers are cut short, then a good one follows."""

    def make(policy):
        asked = []

        def answer(prompt, level, resolution, pixels):
            if not prompt.startswith("List"):
                return "Some heading"
            asked.append(level)
            assert level == "high"
            return ANSWER if len(asked) > bad else '```json\n{"regions": [{"type"'

        return answer

    return make


@pytest.mark.parametrize("bad", [3, 4])
def test_bad_json_is_asked_again(spark, tmp_path, bad):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "s_1.png").write_bytes(images.png(page()))
    out = str(tmp_path / "out")
    summary = documents.run(spark, RunConfig(input_dir=str(tmp_path / "in"), output_dir=out, detection_thinking="high"), client(bad))
    if bad == 3:
        assert summary["errors"] == [] and os.path.exists(f"{out}/md/s_1.md")
    else:
        assert [e["error"].split(":")[0] for e in summary["errors"]] == ["JSON parse"]


def test_parsed_answer():
    for noisy in (ANSWER, f"```json\n{ANSWER}\n```", f"Let me look. {ANSWER} Done."):
        assert text.parsed_answer(noisy) == json.loads(ANSWER)
    for bad in ("", "no json", '{"a": 1', '{"a": }'):
        with pytest.raises(ValueError):
            text.parsed_answer(bad)
