"""Parameters of the analysis, with the usual defaults."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

#: Autosomes by genome prefix.
AUTOSOMES = {"hg": 22, "mm": 19}


@dataclass(frozen=True)
class Params:
    """One field per option; lengths are in base pairs unless they say bins."""

    indir: str = ""
    outdir: str = ""
    chrom_sizes: str = ""
    suffix: str = ""
    chr_columns: tuple[int, int] = (2, 4)
    pos_columns: tuple[int, int] = (3, 5)
    genome: str = "mm10"
    chrom: str | None = None
    max_chrom_number: int = -1
    dist: int = 2_000_000
    binsize: int = 10_000
    low_cutoff: int = 5_000
    alpha: float = 0.05
    rwr_method: str = "inverse"
    blin_partitions: int = 100
    blin_contiguous: bool = False
    nblin_rank: int = 0
    max_iter: int = 30
    window_bins: int = 0
    compat_windows: bool = False
    keep_rwr_matrix: bool = False
    compress_rwr: bool = False
    text: bool = True
    no_hic: bool = False
    no_cool: bool = False
    hic_jar: str | None = None
    cool_tool: str | None = None
    verbose: int = 1
    outlier: float = 1.96
    local_lower_limit: int = 2
    local_upper_limit: int = 5
    tstat_threshold: float = 3.0
    fdr_threshold: float = 0.1
    outlier_threshold_multiplier: float = 0.1
    candidate_lower_distance: int = 100_000
    candidate_upper_distance: int = 2_000_000
    gap_large: int = 5
    gap_small: int = 2
    circle_multiplier: float = 1.33
    donut_multiplier: float = 1.33
    lower_left_multiplier: float = 1.33
    horizontal_multiplier: float = 1.2
    vertical_multiplier: float = 1.2
    clustering_gap: int = 1
    summit_gap: int = 20_000
    filter_file: str | None = None
    steps: tuple[str, ...] = ("bin", "rwr", "hic", "interaction", "postprocess")
    prefix: str = "combined"
    buffer: int = 50_000
    chrom_lengths: dict[str, int] = field(default_factory=dict)

    @property
    def max_bins(self) -> int:
        """Largest distance that is tested, in bins."""
        return self.dist // self.binsize

    @property
    def max_rwr_bins(self) -> int:
        """Largest distance that is imputed, in bins."""
        return (self.dist + self.buffer) // self.binsize

    @property
    def margin(self) -> int:
        """Bins left out at each end of a chromosome."""
        return self.buffer // self.binsize

    @property
    def gap(self) -> int:
        """Least distance of two summits of a cluster; below zero it stands for two bins."""
        return self.summit_gap if self.summit_gap >= 0 else 2 * self.binsize

    def bins(self, chrom: str) -> int:
        """Bins of a chromosome, the last partial one included."""
        return math.ceil(self.chrom_lengths[chrom] / self.binsize)
