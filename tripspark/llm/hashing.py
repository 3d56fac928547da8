"""A mixing function for 64-bit numbers."""

import numpy as np


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit of the input over the output."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))
