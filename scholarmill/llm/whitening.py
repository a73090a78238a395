"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Vectors become whole numbers, and each distinct one counts once. Their sums, and the sums of products of
any two dimensions, are exact: a task adds products of a batch in numbers that cannot overflow, and Spark
adds the tasks' sums in pieces of 30 bits. So M = n * sum(x x') - S S' is an exact integer matrix, and the covariance is
M / n^2.

det(t I - M) has integer coefficients of known size. Tasks reduce M to Hessenberg form modulo a prime
each and read the polynomial off; Chinese remaindering puts the coefficients together. All of its roots
are real, so the sign changes of the polynomial shifted by t are just the number of roots over t. That
isolates the largest roots by halving, each with its exact multiplicity, however close they are; the
common divisor with the derivative tells close roots from equal ones. Solving with the matrix shifted by
a root, in as many decimal digits as the gap to the next root asks for, leaves the null space: the
components, correct to double precision even where eigenvalues nearly tie.

What is on the driver and in one task depends on the number of dimensions only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext
from functools import reduce
from itertools import zip_longest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmill.session import stored

SCALE = 256
COMPONENTS = 4
#: Bits of a piece of an exact sum.
PIECE = 30
#: Vectors multiplied at once.
BATCH = 4096
#: Decimal digits beyond those that the gap between roots takes.
DIGITS = 40

# --- exact sums -----------------------------------------------------------------------------------


def usable(name: str = "embedding") -> Column:
    """Is the vector there, with no null, NaN or infinite entry?"""
    entry = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.col(name).isNotNull() & ~F.coalesce(F.exists(F.col(name).cast("array<double>"), entry), F.lit(True))


def whole_numbers(name: str = "embedding") -> Column:
    """floor(256 * c) of every entry c, which is a double before it is multiplied."""
    return F.transform(F.col(name).cast("array<double>"), lambda c: F.floor(c * SCALE) + F.lit(0))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` numbers; what a shorter vector lacks is 0."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _most(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max())))


def products(x: np.ndarray) -> np.ndarray:
    """x' x as exact whole numbers: eight-byte ones where they are certain to fit, else Python's."""
    largest = _most(x) ** 2 * len(x)
    if largest < 1 << 53:
        y = x.astype(np.float64)  # every sum is below 2^53, so this is exact, and fast
        return (y.T @ y).astype(np.int64)
    if largest < 1 << 63:
        return x.T @ x
    y = x.astype(object)
    return y.T @ y


def _pieces(value: int) -> Iterator[tuple[int, int]]:
    """The number cut in pieces of ``PIECE`` bits: (place, piece), each with the number's sign."""
    sign, value, place = (1 if value >= 0 else -1), abs(value), 0
    while value:
        yield place, sign * (value & ((1 << PIECE) - 1))
        value >>= PIECE
        place += 1


def exact_sums(vectors: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """Number, sums and sums of products of the rows of ``vectors`` (x array of long), as exact numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, squares = 0, [0] * width, np.zeros((width, width), object)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                x = _matrix(batch.column(0).slice(at, BATCH), width)
                count += len(x)
                own = x.sum(axis=0) if _most(x) * len(x) < 1 << 63 else x.astype(object).sum(axis=0)
                sums = [a + b for a, b in zip(sums, own.tolist())]
                squares += products(x)
        if count:
            values = [((-1, 0), count), *(((-2, i), s) for i, s in enumerate(sums))]
            values += [((i, j), squares[i, j]) for i in range(width) for j in range(i, width)]
            rows = [(i, j, place, piece) for (i, j), v in values for place, piece in _pieces(int(v))]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int32()] * 3 + [pa.int64()])]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "place", "piece"])

    summed = vectors.select("x").mapInArrow(run, "i int, j int, place int, piece long")
    total: dict[tuple[int, int], int] = {}
    # A few numbers for each pair of dimensions, whatever the number of rows.
    for r in summed.groupBy("i", "j", "place").agg(F.sum("piece").alias("piece")).collect():
        total[r.i, r.j] = total.get((r.i, r.j), 0) + (r.piece << PIECE * r.place)
    get = lambda i, j: total.get((min(i, j), max(i, j)), 0)
    squares = [[get(i, j) for j in range(width)] for i in range(width)]
    return total.get((-1, 0), 0), [total.get((-2, i), 0) for i in range(width)], squares


# --- the characteristic polynomial ----------------------------------------------------------------


def primes(count: int) -> list[int]:
    """The largest ``count`` primes below 2^31."""
    found, top, size = [], 1 << 31, 1 << 16
    small = np.ones(46_341, bool)
    for p in range(2, 216):
        small[2 * p :: p] = False
    divisors = np.flatnonzero(small)[2:]
    while len(found) < count:
        start = top - size
        free = np.ones(size, bool)
        for p in divisors.tolist():
            free[-start % p :: p] = False
        found += (start + np.flatnonzero(free)[::-1]).tolist()
        top = start
    return found[:count]


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """det(t I - matrix) modulo the prime p < 2^31, highest power first, by Hessenberg reduction."""
    h, n = matrix.copy() % p, len(matrix)
    for k in range(1, n - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        times = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - times[:, None] * h[k] % p) % p
        for row, u in enumerate(times.tolist(), k + 1):
            h[:, k] = (h[:, k] + u * h[:, row] % p) % p
    # Polynomials of the leading blocks, lowest power first.
    lead = [np.array([1], np.int64)]
    for k in range(n):
        new = np.zeros(k + 2, np.int64)
        new[1:] = lead[k]
        new[:-1] = (new[:-1] - h[k, k] * lead[k] % p) % p
        factor = 1
        for i in range(k - 1, -1, -1):
            factor = factor * int(h[i + 1, i]) % p
            if not factor:
                break
            new[: i + 1] = (new[: i + 1] - factor * int(h[i, k]) % p * lead[i] % p) % p
        lead.append(new)
    return lead[n][::-1].tolist()


def _joined(residues: dict[int, list[int]]) -> list[int]:
    """The numbers of least size that leave the given remainders, by Chinese remaindering."""
    modulus = math.prod(residues)
    out = [0] * len(next(iter(residues.values())))
    for p, values in residues.items():
        other = modulus // p
        weight = other * pow(other % p, -1, p)
        out = [a + weight * v for a, v in zip(out, values)]
    return [(a + modulus // 2) % modulus - modulus // 2 for a in out]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """det(t I - matrix), highest power first, of a matrix without negative eigenvalues.

    A coefficient of t^(d-k) is a sum of products of k eigenvalues, at most binomial(d, k) * (trace / d)^k.
    """
    d = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(d)) // d)
    most = max(math.comb(d, k) * mean**k for k in range(d + 1))
    chosen = primes((2 * most + 1).bit_length() // 30 + 1)
    rows = [[str(v) for v in row] for row in matrix]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = [[int(v) for v in row] for row in rows]
        for batch in batches:
            for p in batch.column(0).to_pylist():
                found = polynomial_modulo(np.array([[v % p for v in row] for row in numbers], np.int64), p)
                columns = [pa.array([p], pa.int64()), pa.array([found], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["p", "found"])

    parts = min(len(chosen), max(1, spark.sparkContext.defaultParallelism))
    table = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(parts)
    return _joined({r.p: r.found for r in table.mapInArrow(run, "p long, found array<long>").collect()})


# --- roots ----------------------------------------------------------------------------------------


def _remainder(a: list[int], b: list[int], p: int) -> list[int]:
    """Remainder of polynomials modulo p, highest power first, without leading zeros."""
    a, top = [v % p for v in a], pow(b[0], -1, p)
    while len(a) >= len(b):
        factor = a[0] * top % p
        a = [(u - factor * v) % p for u, v in zip_longest(a, b, fillvalue=0)][1:]
    while a and not a[0]:
        a = a[1:]
    return a


def _common(a: list[int], b: list[int], p: int) -> list[int]:
    """Greatest common divisor modulo p, with first coefficient 1."""
    while b:
        a, b = b, _remainder(a, b, p)
    top = pow(a[0], -1, p)
    return [v * top % p for v in a]


def _quotient(a: list[int], b: list[int]) -> list[int] | None:
    """a / b for b with first coefficient 1, None if something is left over."""
    a, out = a.copy(), []
    while len(a) >= len(b):
        factor = a[0]
        out.append(factor)
        a = [u - factor * v for u, v in zip_longest(a, b, fillvalue=0)][1:]
    return None if any(a) else out


def _stripped(f: list[int], p: int) -> list[int]:
    out = [v % p for v in f]
    while out and not out[0]:
        out = out[1:]
    return out


def without_repeats(f: list[int]) -> list[int]:
    """The polynomial (first coefficient 1) that has each root of ``f`` once."""
    n = len(f) - 1
    slope = [v * (n - i) for i, v in enumerate(f[:-1])]
    residues: dict[int, list[int]] = {}
    degree, done, tried = n + 1, 0, 16
    while True:
        for p in primes(tried)[done:]:
            common = _common(_stripped(f, p), _stripped(slope, p), p)
            if len(common) == 1:
                return f  # what divides both divides them modulo every prime
            if len(common) < degree:  # the primes before have too much in common
                degree, residues = len(common), {}
            if len(common) == degree:
                residues[p] = common
        divisor = _joined(residues)
        quotient = _quotient(f, divisor)
        if quotient and _quotient(slope, divisor):
            return quotient
        done, tried = tried, 2 * tried


def roots_over(f: list[int], t: int, bits: int) -> int:
    """How many roots of ``f``, all of which are real, are over t / 2^bits, counted as often as they occur."""
    n = len(f) - 1
    # Coefficients of 2^(bits n) f(x / 2^bits), then of the same in x + t.
    shifted = [v << bits * i for i, v in enumerate(f)]
    for end in range(n, 0, -1):
        for i in range(1, end + 1):
            shifted[i] += t * shifted[i - 1]
    signs = [v > 0 for v in shifted if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


class Root:
    """A distinct root, in the open-closed interval (low, low + 1] / 2^bits, and its multiplicity."""

    def __init__(self, low: int, bits: int, times: int):
        self.low, self.bits, self.times = low, bits, times

    def touches(self, below: Root) -> bool:
        bits = max(self.bits, below.bits)
        return self.low << bits - self.bits <= below.low + 1 << bits - below.bits

    def narrow(self, f: list[int]) -> None:
        """Halve the interval; ``f`` has the root once and no other in the interval."""
        middle, bits = 2 * self.low + 1, self.bits + 1
        above = roots_over(f, middle, bits) > roots_over(f, 2 * self.low + 2, bits)
        self.low, self.bits = (middle if above else middle - 1), bits

    def sharpen(self, f: list[int], bits: int) -> None:
        """Narrow to ``bits`` bits after the point; signs of ``f`` at the middles are enough."""
        if bits <= self.bits:
            return
        n, extra = len(f) - 1, bits - self.bits
        low, high = self.low << extra, (self.low + 1) << extra
        at = lambda x: reduce(lambda v, i: v * x + (f[i] << bits * i), range(1, n + 1), f[0])
        end = at(high)
        if not end:
            low = high - 1
        while high - low > 1:
            middle = (low + high) // 2
            value = at(middle)
            if not value:
                low, high = middle - 1, middle
            elif (value > 0) == (end > 0):
                high = middle
            else:
                low = middle
        self.low, self.bits = low, bits

    def decimal(self) -> Decimal:
        return Decimal(2 * self.low + 1) / Decimal(1 << self.bits + 1)


def largest_roots(f: list[int], wanted: int, most: int) -> list[Root]:
    """The largest distinct roots, falling, until ``wanted`` are counted with multiplicity and one more.

    All roots are real and none is negative or over ``most``. The intervals do not touch.
    """
    simple = without_repeats(f)
    top = 1 << most.bit_length()
    found: list[Root] = []
    # Intervals (low, high] in units of 2^-bits with the number of distinct roots over each end.
    todo = [(-1, top, 0, len(simple) - 1, 0)]
    while todo and sum(r.times for r in found[:-1]) < wanted:
        low, high, bits, over_low, over_high = todo.pop()
        if over_low == over_high:
            continue
        if high - low == 1 and over_low - over_high == 1:
            found.append(Root(low, bits, roots_over(f, low, bits) - roots_over(f, high, bits)))
            continue
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        over = roots_over(simple, middle, bits)
        todo += [(low, middle, bits, over_low, over), (middle, high, bits, over, over_high)]
    for above, below in zip(found, found[1:]):
        while above.touches(below):
            above.narrow(simple)
            below.narrow(simple)
    return found


# --- components -----------------------------------------------------------------------------------


def _null_space(matrix: list[list[int]], root: Decimal, times: int, digits: int) -> list[list[Decimal]]:
    """``times`` orthonormal vectors that the matrix less ``root`` sends next to nothing, by inverse iteration."""
    d = len(matrix)
    with localcontext() as context:
        context.prec = digits
        rows = [[Decimal(v) for v in row] for row in matrix]
        for i in range(d):
            rows[i][i] -= root
        # Elimination with the largest pivot; a pivot of nothing is what the root's precision makes of 0.
        least = max(abs(v) for row in rows for v in row).scaleb(-digits)
        order = list(range(d))
        for k in range(d):
            pivot = max(range(k, d), key=lambda i: abs(rows[i][k]))
            rows[k], rows[pivot], order[k], order[pivot] = rows[pivot], rows[k], order[pivot], order[k]
            if abs(rows[k][k]) < least:
                rows[k][k] = least
            top = rows[k]
            for i in range(k + 1, d):
                row = rows[i]
                u = row[k] = row[k] / top[k]
                if u:
                    row[k + 1 :] = [a - u * b for a, b in zip(row[k + 1 :], top[k + 1 :])]

        def solve(y: list[Decimal]) -> list[Decimal]:
            y = [y[i] for i in order]
            for i in range(d):
                y[i] -= sum((a * b for a, b in zip(rows[i][:i], y[:i])), Decimal(0))
            for i in reversed(range(d)):
                y[i] = (y[i] - sum((a * b for a, b in zip(rows[i][i + 1 :], y[i + 1 :])), Decimal(0))) / rows[i][i]
            return y

        def dot(a, b):
            return sum((u * v for u, v in zip(a, b)), Decimal(0))

        def orthonormal(vectors):
            out: list[list[Decimal]] = []
            for y in vectors:
                size = dot(y, y).sqrt()
                y = [a / size for a in y]
                for _ in range(2):
                    for q in out:
                        s = dot(q, y)
                        y = [a - s * b for a, b in zip(y, q)]
                    size = dot(y, y).sqrt()
                    y = [a / size for a in y]
                out.append(y)
            return out

        # Fixed starts without a pattern that a matrix is likely to have.
        space = [[Decimal((i + 1) * (2 * j + 3) * 7919 % 10_007 + 1) for i in range(d)] for j in range(times)]
        for _ in range(3):
            space = orthonormal([solve(y) for y in space])
        return space


class Components:
    """Means, directions and eigenvalues of the first components, as numbers of double precision.

    ``values`` are eigenvalues of the covariance, ``vectors`` rows of unit length, ``shares`` the parts
    of the trace. A component without variance has the value 0 and no direction (a row of zeros).
    """

    def __init__(self, count: int, sums: list[int], values: list[float], vectors: np.ndarray, shares: list[float | None]):
        self.count, self.sums, self.values, self.vectors, self.shares = count, sums, values, vectors, shares

    def whitened(self, x: np.ndarray) -> tuple[list[int], np.ndarray]:
        """sum((n x - S)^2), exact, and the whitened values of every row of ``x``."""
        n = self.count
        widest = n * _most(x) + max(map(abs, self.sums))
        kind = np.int64 if widest * widest * x.shape[1] < 1 << 63 else object
        apart = n * x.astype(kind) - np.array(self.sums, dtype=kind)
        deviation = (apart * apart).sum(axis=1)
        centred = (apart / n).astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            return deviation.tolist(), centred @ self.vectors.T / np.sqrt(np.array(self.values))


def components(spark: SparkSession, count: int, sums: list[int], squares: list[list[int]], wanted: int = COMPONENTS) -> Components:
    """The first components of ``count`` vectors with these sums and sums of products."""
    d = len(sums)
    wanted = min(wanted, d)
    matrix = [[count * squares[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(matrix[i][i] for i in range(d))
    values, vectors, shares = [0.0] * wanted, np.zeros((wanted, d)), [0.0 if trace else None] * wanted
    if not trace:
        return Components(count, sums, values, vectors, shares)
    # What divides all entries only makes the roots longer.
    unit = math.gcd(*(v for row in matrix for v in row))
    matrix = [[v // unit for v in row] for row in matrix]
    trace //= unit
    f = characteristic_polynomial(spark, matrix)
    roots = largest_roots(f, wanted, trace)
    simple = without_repeats(f)
    at = 0
    for k, root in enumerate(roots):
        if at >= wanted or root.low < 0:
            break  # the interval (-1, 0] holds the root 0
        # Intervals that do not touch are at least the narrowest apart, so bits beyond it resolve the gap.
        fine = max(r.bits for r in roots[max(0, k - 1) : k + 2])
        bits = fine + math.ceil(DIGITS * math.log2(10))
        root.sharpen(simple, bits)
        digits = math.ceil((bits + trace.bit_length()) * math.log10(2)) + DIGITS
        with localcontext() as context:
            context.prec = digits
            value = root.decimal()
            e, share = float(value * unit / count**2), float(value / trace)
            space = _null_space(matrix, value, min(root.times, wanted - at), digits)
        for y in space:
            values[at], shares[at] = e, share
            vectors[at] = [float(a) for a in y]
            at += 1
    return Components(count, sums, values, vectors, shares)


# --- the operator ---------------------------------------------------------------------------------


def _identity_error(vectors: DataFrame, found: Components, width: int) -> float | None:
    """The largest entry of the covariance of the whitened vectors less the identity, in size.

    Means first, then products about them. Components without variance have no whitened values; without
    any component that has some there is no covariance.
    """
    ranks = [k for k, v in enumerate(found.values) if v]
    if not ranks:
        return None
    names = [f"w{k}" for k in ranks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                _, w = found.whitened(_matrix(batch.column(0).slice(at, BATCH), width))
                yield pa.RecordBatch.from_arrays([pa.array(w[:, k]) for k in ranks], names=names)

    white = vectors.select("x").mapInArrow(run, ", ".join(f"{c} double" for c in names))
    means = white.agg(*(F.avg(c).alias(c) for c in names)).first()
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    about = {c: F.col(c) - F.lit(means[c]) for c in names}
    row = white.agg(*(F.avg(about[a] * about[b]).alias(f"{a}_{b}") for a, b in pairs)).first()
    return max(abs(row[f"{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(embeddings: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """Every usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose ``embedding`` is null or has a null, NaN or infinite entry are dropped. The rest are fitted
    and whitened by x = floor(256 c), where numbers beyond a long become the nearest long; what a vector
    lacks to the longest counts as 0. Vectors that occur repeatedly, under any vec_id, are fitted once, and
    every row is returned; null vec_ids stay null. ``deviation`` is decimal(38, 0), null beyond that. A
    component without variance has whitened null and explained 0, or null if none has any; so has
    identity_error then. An empty table, or vectors of no entries, give no rows. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = embeddings.where(usable()).select(F.col("vec_id").alias("vec_id"), whole_numbers().alias("x"))
    schema = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    width = rows.agg(F.max(F.size("x")).alias("width")).first().width or 0
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not width:
        return spark.createDataFrame([], f"vec_id {kind}, {schema}")
    missing = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
    rows = rows.withColumn("x", F.when(F.size("x") < width, F.concat("x", missing)).otherwise(F.col("x")))
    # Equal vectors meet after each task has put its own together, so a frequent one is a row a task.
    distinct = stored(rows.select("x").distinct())
    count, sums, squares = exact_sums(distinct, width)
    found = components(spark, count, sums, squares, wanted)
    error = _identity_error(distinct, found, width)
    wanted = len(found.values)
    names = ["vec_id", *(c.split(" ")[0] for c in schema.split(", "))]
    limit = 10**38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = [v > 0 for v in found.values]
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                deviation, w = found.whitened(_matrix(part.column(1), width))
                m = len(deviation)
                which = np.repeat(np.arange(m), wanted)
                told = pa.array([Decimal(v) if v < limit else None for v in deviation], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(which)),
                    pa.array(np.tile(np.arange(1, wanted + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * wanted, count, np.int64)),
                    told.take(pa.array(which)),
                    pa.array(w.ravel(), mask=~np.tile(some, m)),
                    pa.array(found.shares * m, pa.float64()),
                    pa.array([error] * (m * wanted), pa.float64()),
                ], names=names)

    return rows.mapInArrow(run, f"vec_id {kind}, {schema}")
