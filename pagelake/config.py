"""Run configuration and command line."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable
from dataclasses import dataclass

# The kinds of documents, and the settings of a run with their defaults.
DOC_TYPES = ["text", "table", "graph", "map", "mixed"]


@dataclass(frozen=True)
class RunConfig:
    """All knobs of a document run. Layout types detect regions; the others are read in one pass per page."""

    input_dir: str = "input"
    output_dir: str = "output"
    model_id: str = "stub"
    client: str = "pagelake.operators.model:stub_client"
    single_page: bool = True
    split_overlap_px: int = 10
    doc_type: str = "mixed"
    deskew: bool = False
    enhance_contrast: bool = True
    sharpen: bool = True
    max_regions: int = 12
    region_margin_frac: float = 0.003
    detection_temperature: float = 1.0
    detection_thinking: str = "high"
    detection_retries: int = 3
    transcription_temperature: float = 1.0
    transcription_thinking: str = "low"
    transcription_retries: int = 2
    full_page_thinking: str = "high"
    full_page_retries: int = 2
    max_output_tokens: int = 65_536
    region_media_resolution: str = "high"
    full_page_media_resolution: str = "high"
    graph_media_resolution: str = "ultra_high"
    detection_media_resolution: str = "high"
    output_md: bool = True
    workers: int = 4
    listed_errors: int = 10_000  # in the summary; the table of errors holds all

    def __post_init__(self):
        if self.doc_type not in DOC_TYPES:
            raise ValueError(f"unknown doc_type {self.doc_type!r}; one of {', '.join(DOC_TYPES)}")

    def client_factory(self) -> Callable:
        """The factory that client names as module:factory."""
        module, _, name = self.client.partition(":")
        return getattr(importlib.import_module(module), name)

    @property
    def uses_region_detection(self) -> bool:
        return self.doc_type in ("text", "mixed")


def parse_args(argv: list[str]) -> RunConfig:
    p = argparse.ArgumentParser(prog="pagelake", description="Page scans to Markdown, JSON and a run summary.")
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--model", default=RunConfig.model_id)
    p.add_argument("--client", default="pagelake.operators.model:stub_client", help="module:factory of the recognition client")
    p.add_argument("--temperature", type=float, default=1.0)
    p.add_argument("--max-output-tokens", type=int, default=RunConfig.max_output_tokens)
    p.add_argument("--doc-type", default="mixed")
    p.add_argument("--double-page", action="store_true")
    p.add_argument("--deskew", action="store_true")
    p.add_argument("--no-enhance-contrast", action="store_true")
    p.add_argument("--no-sharpen", action="store_true")
    p.add_argument("--max-regions", type=int, default=12)
    p.add_argument("-w", "--workers", type=int, default=4)
    a = p.parse_args(argv)
    return RunConfig(input_dir=a.input, output_dir=a.output, model_id=a.model, doc_type=a.doc_type, client=a.client, detection_temperature=a.temperature, transcription_temperature=a.temperature, max_output_tokens=a.max_output_tokens, single_page=not a.double_page, deskew=a.deskew, enhance_contrast=not a.no_enhance_contrast, sharpen=not a.no_sharpen, max_regions=a.max_regions, workers=a.workers)
