"""Exact characteristic polynomials, their real roots and null spaces, over Python integers.

Small helpers for one square integer matrix; nothing here knows of Spark.
"""

import math

import numpy as np

PRIME_LIMIT = 1 << 31


def primes_below(limit, count):
    """The `count` largest primes below `limit` (at most 2^32), by Miller and Rabin's test."""

    def is_prime(n):
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # enough below 3,215,031,751
            x = pow(base, odd, n)
            if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
                return False
        return True

    found, n = [], (limit - 1) | 1
    n = n if n < limit else n - 2
    while len(found) < count:
        if is_prime(n):
            found.append(n)
        n -= 2
    return found


def polynomial_mod(matrix, prime):
    """Coefficients, lowest first, of det(x - matrix) modulo a prime under 2^31.

    Similarity steps bring the matrix to Hessenberg form; its leading minors then give
    the polynomial by a recurrence.
    """
    h = np.array([[v % prime for v in row] for row in matrix], dtype=np.int64).reshape(len(matrix), len(matrix))
    size = len(h)
    for m in range(1, size - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        factor = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, prime) % prime
        h[m + 1 :] = (h[m + 1 :] - factor[:, None] * h[m][None, :] % prime) % prime
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factor[None, :] % prime).sum(axis=1)) % prime
    minors = np.zeros((size + 1, size + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, size + 1):
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] = (minors[k] - int(h[k - 1, k - 1]) * minors[k - 1] % prime) % prime
        chain = 1
        weights = np.zeros(k - 1, np.int64)
        for i in range(k - 2, -1, -1):
            chain = chain * int(h[i + 1, i]) % prime
            weights[i] = chain * int(h[i, k - 1]) % prime
        if k > 1:
            minors[k] = (minors[k] - (weights[:, None] * minors[: k - 1] % prime).sum(axis=0)) % prime
    return [int(v) for v in minors[size]]


def primes_needed(size, trace):
    """So many primes that their product exceeds twice any coefficient.

    The matrix has no negative eigenvalue, so the k-th elementary symmetric sum is at
    most C(size, k) * (trace / size)^k.
    """
    bits = max(
        (math.log2(math.comb(size, k)) + k * max(0.0, math.log2(max(trace, 1)) - math.log2(size)) for k in range(size + 1)),
        default=0.0,
    )
    return int((bits + 2) / 30.9) + 2


def remaindered(residues, primes):
    """Signed integers from their residues: one list of residues for each prime."""
    product = math.prod(primes)
    weights = [product // p * pow(product // p % p, -1, p) for p in primes]
    found = []
    for column in zip(*residues):
        value = sum(r * w for r, w in zip(column, weights)) % product
        found.append(value - product if 2 * value > product else value)
    return found


def roots_above(polynomial, point, scale):
    """How many roots exceed point / 2^scale, for a polynomial with real roots only.

    Shifted by the point, such a polynomial has exactly as many positive roots as its
    coefficients have changes of sign.
    """
    size = len(polynomial) - 1
    shifted = [c << (scale * (size - k)) for k, c in enumerate(polynomial)]
    for first in range(size):
        for k in range(size - 1, first - 1, -1):
            shifted[k] += point * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(polynomial, count, scale):
    """The largest roots times 2^scale, rounded down, falling and with multiplicity.

    Zero roots are left out. Bisection by counting isolates each root; the sign of the
    polynomial then narrows a lone root further.
    """
    zeros = next((k for k, c in enumerate(polynomial) if c), len(polynomial) - 1)
    polynomial = polynomial[zeros:]
    size = len(polynomial) - 1
    count = min(count, size)
    top = -polynomial[-2] + 1 if size else 1  # the sum of all roots bounds each
    counts = {}

    def above(point):
        if point not in counts:
            counts[point] = roots_above(polynomial, point, scale)
        return counts[point]

    scaled = [c << (scale * (size - k)) for k, c in enumerate(polynomial)]

    def value(point):
        total = 0
        for c in reversed(scaled):
            total = total * point + c
        return total

    found = []
    for rank in range(1, count + 1):
        low, high = 0, top << scale
        for point, n in counts.items():
            if n >= rank:
                low = max(low, point)
            else:
                high = min(high, point)
        while high - low > 1 and not above(low) - above(high) == 1:
            middle = (low + high) // 2
            low, high = (middle, high) if above(middle) >= rank else (low, middle)
        if value(high) == 0:
            found.append(high)
            continue
        sign = value(high) > 0
        while high - low > 1:
            middle = (low + high) // 2
            at = value(middle)
            if at == 0:
                low, high = middle, middle + 1
            elif (at > 0) == sign:
                high = middle
            else:
                low = middle
        found.append(low)
    return found


def null_vectors(matrix, root, count, scale, bits=192):
    """`count` orthonormal vectors that matrix * 2^scale - root sends next to zero.

    Inverse iteration in fixed point: one elimination with partial pivots, three solves
    for each vector, orthogonal to the ones before.
    """
    size = len(matrix)
    a = np.array([[int(v) << scale for v in row] for row in matrix], dtype=object).reshape(size, size)
    for k in range(size):
        a[k, k] -= root
    order = np.arange(size)
    for k in range(size):
        pivot = k + max(range(size - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[[k, pivot]] = order[[pivot, k]]
        if a[k, k] == 0:
            a[k, k] = 1  # singular in fixed point: the smallest step stands in
        if k + 1 < size:
            a[k + 1 :, k] = (a[k + 1 :, k] << bits) // a[k, k]
            a[k + 1 :, k + 1 :] -= (a[k + 1 :, k][:, None] * a[k, k + 1 :][None, :]) >> bits

    def solve(b):
        x = b[order]
        for k in range(size):
            x[k + 1 :] -= (a[k + 1 :, k] * x[k]) >> bits
        for k in range(size - 1, -1, -1):
            x[k] = (x[k] << bits) // a[k, k]
            x[:k] -= (a[:k, k] * x[k]) >> bits
        return x

    def unit(x):
        length = math.isqrt(int((x * x).sum()))
        return (x << bits) // length if length else x

    found = []
    for turn in range(count):
        rng = np.random.default_rng(turn)
        x = np.array([int(v) << (bits - 20) for v in rng.integers(1, 1 << 20, size)], dtype=object)
        for _ in range(3):
            x = unit(solve(x))
            for other in found:
                x = x - ((other * (int((x * other).sum()) >> bits)) >> bits)
            x = unit(x)
        found.append(x)
    vectors = [np.array([int(v) / (1 << bits) for v in x]) for x in found]
    return [v * (1.0 if v[np.abs(v).argmax()] >= 0 else -1.0) for v in vectors]
