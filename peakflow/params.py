"""Stage parameters and the two calculation modes."""

from __future__ import annotations

from dataclasses import dataclass

#: Reproduces the published calculation, oddities included.
REFERENCE = "reference"
#: Computes what the published calculation says it does.
CORRECTED = "corrected"

#: Pseudo internal standard that stands for "normalise by injection volume only".
INJECTION_VOLUME = "Inj_vol"


def is_corrected(mode: str) -> bool:
    """True for the corrected mode; any other unknown name is an error."""
    if mode not in (REFERENCE, CORRECTED):
        raise ValueError(f"unknown mode {mode!r}: use {REFERENCE!r} or {CORRECTED!r}")
    return mode == CORRECTED


@dataclass(frozen=True)
class QcParams:
    """Thresholds of the quality-control flags (defaults: HILIC columns)."""

    area_min: float = 1000.0
    rt_flex: float = 0.4
    blk_thresh: float = 0.3
    sn_min: float = 4.0
    height_min: float = 1000.0
    height_max: float = 1.0e8
    ir_flex: float = 0.3

    @classmethod
    def reverse_phase(cls) -> "QcParams":
        return cls(area_min=5000.0, rt_flex=0.2, blk_thresh=0.2)


@dataclass(frozen=True)
class BmisParams:
    """Acceptance thresholds for a best-matched internal standard."""

    cut_off: float = 0.4
    cut_off2: float = 0.1


@dataclass(frozen=True)
class QuantifyParams:
    """Volumes and the column type of a quantification run."""

    dilution_factor: float = 2.0
    reconstitution_volume: float = 400.0
    volume_filtered: float = 5.0
    column_type: str = "HILIC"
