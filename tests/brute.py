"""Plain NumPy answers for small inputs."""

from itertools import combinations

import numpy as np

from bandwise.functions.simhash import hyperplanes


def sign_bits(matrix, m, seed=42):
    matrix = np.asarray(matrix, dtype=np.float64)
    return (matrix @ hyperplanes(m, matrix.shape[1], seed).T > 0).astype(int)


def buckets(bits, b):
    r = bits.shape[1] // b
    found = {}
    for i, row in enumerate(bits):
        for band in range(b):
            found.setdefault((band, tuple(row[band * r : (band + 1) * r])), []).append(i)
    return found


def candidates(bits, b):
    pairs = set()
    for members in buckets(bits, b).values():
        pairs.update(combinations(sorted(members), 2))
    return pairs


def scored(matrix, bits, pairs):
    matrix = np.asarray(matrix, dtype=np.float64)
    out = []
    for i, j in sorted(pairs):
        lengths = np.linalg.norm(matrix[i]) * np.linalg.norm(matrix[j])
        cos = float(matrix[i] @ matrix[j] / lengths) if lengths > 0 else None
        out.append((i, j, int((bits[i] != bits[j]).sum()), cos))
    return out


def quality(rows, ks, m):
    table = {}
    for k in ks:
        near = [row for row in rows if row[2] <= k]
        cosines = [row[3] for row in near if row[3] is not None]
        table[k] = (
            len({d for row in near for d in row[:2]}),
            len(near),
            float(np.mean(cosines)) if cosines else 0.0,
            float(np.mean([row[2] for row in near])) if near else 0.0,
            float(np.mean([np.cos(row[2] * np.pi / m) for row in near])) if near else 0.0,
        )
    return table
