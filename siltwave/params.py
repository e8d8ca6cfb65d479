"""The parameters of a job."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    threshold: float = 5.0  # in sigma of the gate
    gap: int = 2  # samples below threshold that are bridged
    prominence: float = 4.0  # in sigma: depth of a valley that splits a pulse
    min_width: int = 3
    baseline_window: int = 4
    baseline_guard: int = 2
    saturation: float = 0.94
    saturated_samples: int = 2
    slope_samples: int = 3
    boxcar_ns: float = 300.0
    boxcar_width: int = -1  # -1: from boxcar_ns
    zs_baseline: float = 256.0
    force_zs_baseline: bool = False
    sample_ns: float = 60.0
    ftst_ns: float = 10.0
    tick_ns: int = 10
    timing_fraction: float = 0.3
    adc_max: float = 4095.0
    many_peaks: bool = True
    cns: bool = True
    channels: int = 512
    samples: int = 2048

    def gate_width(self, with_pedestal: bool = True, sample_ns: float | None = None) -> int:
        if not with_pedestal:
            return 0
        if self.boxcar_width >= 0:
            return self.boxcar_width
        return max(3, int(self.boxcar_ns / (sample_ns or self.sample_ns) + 0.5))
