"""Job parameters with range checks."""

from __future__ import annotations

from dataclasses import dataclass, fields


@dataclass(frozen=True)
class JobParams:
    window_size: int = 30
    model_name: str = "wear_classifier"
    f2_threshold: float = 0.75
    critical_recall_threshold: float = 0.75
    max_engines: int | None = None
    val_split: float = 0.2
    test_split: float = 0.2
    seed: int = 42
    patience: int = 5
    reg_params: tuple[float, ...] = (0.0, 0.001, 0.01)
    max_iter: int = 50
    enforce_gate: bool = True

    def __post_init__(self) -> None:
        if isinstance(self.window_size, bool) or not isinstance(self.window_size, int):
            raise TypeError(f"window_size must be an int, got {self.window_size!r}")
        if self.window_size <= 0:
            raise ValueError(f"window_size must be positive, got {self.window_size}")
        if not self.model_name:
            raise ValueError("model_name must not be empty")
        for name in ("f2_threshold", "critical_recall_threshold"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie in [0, 1], got {getattr(self, name)}")
        if not self.reg_params:
            raise ValueError("at least one training candidate is required")
        if self.patience < 1:
            raise ValueError(f"patience must be at least 1, got {self.patience}")

    @classmethod
    def from_mapping(cls, values: dict) -> JobParams:
        """Build from a plain mapping, refusing keys that no parameter has."""
        known = {field.name for field in fields(cls)}
        unknown = sorted(set(values) - known)
        if unknown:
            raise ValueError(f"unknown job parameters: {unknown}")
        return cls(**values)
