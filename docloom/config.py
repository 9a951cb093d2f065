"""Run configuration: defaults, overrides by file and by command line, and the closure of stages."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field, fields, is_dataclass, replace

STAGES = ("router", "layout", "extract", "quality", "parquet")
#: What a stage needs before it, directly.
NEEDS = {"layout": ("router",), "extract": ("router",), "quality": ("extract",), "parquet": ("quality",)}


def stage_closure(stages: Iterable[str]) -> list[str]:
    """Stages with all they need, in canonical order; ``layout`` is only there if asked for. Unknown names raise ValueError."""
    todo, found = list(stages), set()
    while todo:
        stage = todo.pop()
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage!r}; there are {', '.join(STAGES)}")
        if stage not in found:
            found.add(stage)
            todo.extend(NEEDS.get(stage, ()))
    return [s for s in STAGES if s in found]


@dataclass(frozen=True)
class Input:
    pdf_dir: str = ""
    limit: int | None = None


@dataclass(frozen=True)
class Router:
    ocr_threshold: float = 0.5
    vlm_enabled: bool = False
    model: str = "rules@1"


@dataclass(frozen=True)
class Layout:
    model: str = "rules@1"
    conf_threshold: float = 0.25
    render_dpi: int = 200
    min_region_px: int = 10


@dataclass(frozen=True)
class Vlm:
    enabled: bool = False
    include_simple_pages: bool = False


@dataclass(frozen=True)
class Quality:
    enabled: bool = True
    model: str = "rules@1"
    max_chars: int = 10_000


@dataclass(frozen=True)
class Publish:
    out: str = "dataset.parquet"
    compression: str = "zstd"
    quality_threshold: float = 2.0
    include_markdown: bool = True


@dataclass(frozen=True)
class RunConfig:
    stages: tuple[str, ...] = STAGES
    input: Input = field(default_factory=Input)
    router: Router = field(default_factory=Router)
    layout: Layout = field(default_factory=Layout)
    vlm: Vlm = field(default_factory=Vlm)
    quality: Quality = field(default_factory=Quality)
    publish: Publish = field(default_factory=Publish)


def _filled(node, values: Mapping):
    known = {f.name for f in fields(node)}
    changes = {}
    for name, value in values.items():
        if name in known and value is not None:
            old = getattr(node, name)
            changes[name] = _filled(old, value) if is_dataclass(old) and isinstance(value, Mapping) else value
    return replace(node, **changes)


def build(file_values: Mapping | None = None, *, pdf_dir: str | None = None, limit: int | None = None, stages: Iterable[str] | None = None, vlm: bool = False, no_quality: bool = False, ocr_threshold: float | None = None, quality_model: str | None = None) -> RunConfig:
    """Command line over file over defaults. Unknown keys are ignored; ``vlm`` can only turn on; without quality its stages drop out too."""
    config = _filled(RunConfig(), file_values or {})
    config = _filled(config, {"input": {"pdf_dir": pdf_dir, "limit": limit}, "router": {"ocr_threshold": ocr_threshold}, "quality": {"model": quality_model}})
    if vlm:
        config = _filled(config, {"vlm": {"enabled": True}})
    wanted = stage_closure(stages if stages is not None else config.stages)
    if no_quality:
        config = _filled(config, {"quality": {"enabled": False}})
        wanted = [s for s in wanted if s not in ("quality", "parquet")]
    return replace(config, stages=tuple(wanted))


def to_dict(config: RunConfig) -> dict:
    return asdict(config)


def load(path: str, **overrides) -> RunConfig:
    """Configuration from a JSON or, where a YAML library is installed, YAML file."""
    import json

    with open(path) as f:
        text = f.read()
    if path.endswith(".json"):
        values = json.loads(text)
    else:
        import yaml

        values = yaml.safe_load(text)
    return build(values or {}, **overrides)
