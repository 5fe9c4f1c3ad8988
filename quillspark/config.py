"""Settings with environment overrides."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Settings:
    """Each field may be overridden by QUILL_<NAME>."""

    min_script_ratio: float = 0.65
    max_rewrites: int = 3
    max_attempts: int = 3
    batch_size: int = 100
    near_dup_threshold: float = 0.92
    near_dup_recent: int = 500
    avoid_openers: int = 5
    opener_min_repeats: int = 2
    opener_tokens: int = 6
    exemplars: int = 3
    exemplar_min_score: float = 1.4
    cohort_min_rows: int = 20
    cohort_top: int = 6
    sample_reasons: int = 5
    histogram_top: int = 12
    memory_enabled: bool = True
    llm_url: str = "http://localhost:8000/v1/chat/completions"
    llm_model: str = "local-model"
    llm_key: str = field(default="", repr=False)
    llm_temperature: float = 0.8
    llm_max_tokens: int = 800
    llm_timeout: float = 120.0
    llm_tries: int = 3
    embed_url: str = ""
    embed_model: str = ""
    log_file: str = ""
    judge_batch_size: int = 25
    judge_temperature: float = 0.1
    judge_max_tokens: int = 500
    concurrency: int = 50

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        got = {}
        for f in fields(cls):
            raw = env.get(f"QUILL_{f.name.upper()}")
            if raw is not None:
                kind = type(f.default)
                got[f.name] = raw.lower() in ("1", "true", "yes") if kind is bool else kind(raw)
        return cls(**got)
