"""Typed settings, readable from YAML."""

from __future__ import annotations

import os
import warnings
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any, get_type_hints


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} {value!r}; one of {', '.join(allowed)}")


@dataclass
class DatasetConfig:
    name: str = ""
    split: str = "train"
    max_episodes: int | None = None
    shuffle: bool = False
    shuffle_seed: int = 42
    image_size: tuple[int, int] | None = (256, 256)
    cache_dir: str | None = None

    @property
    def splits(self) -> list[str]:
        """The splits named, one or several with + or commas between them."""
        return [s for s in self.split.replace("+", ",").replace(" ", "").split(",") if s]


@dataclass
class AnnotationConfig(DatasetConfig):
    name: str = "embodied_features_bridge"
    local_path: str | None = None
    require_reasoning: bool = False


@dataclass
class DemonstrationConfig(DatasetConfig):
    name: str = "bridge_v2"
    source: str = "parquet"
    local_path: str | None = None
    include_secondary_camera: bool = True

    def __post_init__(self) -> None:
        _one_of("source", self.source, ("parquet", "tfds", "rlds", "hdf5"))
        if self.source in ("hdf5", "rlds") and not self.local_path:
            raise ValueError(f"source {self.source!r} needs local_path")


@dataclass
class BackendConfig:
    provider: str = "mock"
    model_name: str = "mock"
    api_key_env_var: str = ""
    max_tokens: int = 1024
    temperature: float = 0.0
    top_p: float = 1.0
    max_retries: int = 5
    retry_base_delay: float = 1.0
    retry_max_delay: float = 60.0
    requests_per_minute: int | None = None
    timeout: float = 120.0
    base_url: str | None = None
    detail: str = "auto"
    safety_settings: dict[str, str] = field(default_factory=dict)
    mode: str = "api"
    local_model_path: str | None = None
    device: str = "cuda"

    def __post_init__(self) -> None:
        _one_of("mode", self.mode, ("api", "local"))
        _one_of("detail", self.detail, ("auto", "low", "high"))
        if self.mode == "local" and not self.local_model_path:
            raise ValueError("mode 'local' needs local_model_path")
        if self.mode == "local" and self.provider != "mock":
            raise ValueError("local model checkpoints are not offered; serve the model and give its base_url")
        if self.api_key_env_var and not os.environ.get(self.api_key_env_var):
            warnings.warn(f"environment variable {self.api_key_env_var!r} is not set; requests will fail", stacklevel=2)


# Models and key variables by provider, unless settings say otherwise.
PROVIDERS = {
    "mock": {"model_name": "mock"},
    "gemini": {"model_name": "gemini-1.5-pro", "api_key_env_var": "GOOGLE_API_KEY"},
    "openai": {"model_name": "gpt-4o", "api_key_env_var": "OPENAI_API_KEY"},
    "qwen": {"model_name": "qwen-vl-max", "api_key_env_var": "DASHSCOPE_API_KEY"},
}


@dataclass
class FrameSamplingConfig:
    strategy: str = "uniform"
    num_frames: int = 8
    keyframe_threshold: float = 0.05

    def __post_init__(self) -> None:
        _one_of("strategy", self.strategy, ("uniform", "keyframe", "all"))


@dataclass
class GenerationConfig:
    dataset: AnnotationConfig = field(default_factory=AnnotationConfig)
    backend: BackendConfig = field(default_factory=BackendConfig)
    frame_sampling: FrameSamplingConfig = field(default_factory=FrameSamplingConfig)
    output_dir: str = "outputs/generation"
    resume: bool = True
    dry_run: bool = False
    save_raw_responses: bool = True
    per_step: bool = False


@dataclass
class CurationConfig:
    annotations: AnnotationConfig = field(default_factory=AnnotationConfig)
    demonstrations: DemonstrationConfig = field(default_factory=DemonstrationConfig)
    alignment_strategy: str = "nearest"
    output_dir: str = "outputs/curated"
    export_format: str = "parquet"
    schema_version: str = "1.0"
    validate_output: bool = True
    save_images: bool = False
    image_output_dir: str | None = None

    def __post_init__(self) -> None:
        _one_of("alignment_strategy", self.alignment_strategy, ("exact", "nearest", "broadcast"))
        _one_of("export_format", self.export_format, ("parquet", "rlds", "jsonl", "tfrecord"))
        if self.image_output_dir is None:
            self.image_output_dir = f"{self.output_dir}/images"


def from_dict(kind: type, data: dict[str, Any]) -> Any:
    """A settings object from nested mappings; unknown names fail."""
    hints = get_type_hints(kind)
    names = {f.name for f in fields(kind)}
    if unknown := set(data) - names:
        raise ValueError(f"{kind.__name__} has no {', '.join(sorted(unknown))}")
    return kind(**{k: from_dict(hints[k], v) if is_dataclass(hints[k]) and isinstance(v, dict) else v for k, v in data.items()})


def load(path: str | Path, kind: type) -> Any:
    """Settings from a YAML file."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return from_dict(kind, yaml.safe_load(f) or {})


def load_backend(path: str | Path) -> BackendConfig:
    """Backend settings from a YAML file, with the defaults of its provider; an unknown provider fails."""
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    provider = data.get("provider", "gemini")
    _one_of("provider", provider, tuple(PROVIDERS))
    return from_dict(BackendConfig, PROVIDERS[provider] | data | {"provider": provider})
