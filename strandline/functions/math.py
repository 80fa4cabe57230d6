"""Normal distribution as SQL expressions, which run unchanged in Spark and DuckDB."""

from __future__ import annotations

# Coefficients of algorithm AS 241 (PPND16), highest power last.
_A = ("3.3871328727963666080e0", "1.3314166789178437745e2", "1.9715909503065514427e3", "1.3731693765509461125e4", "4.5921953931549871457e4", "6.7265770927008700853e4", "3.3430575583588128105e4", "2.5090809287301226727e3")
_B = ("1e0", "4.2313330701600911252e1", "6.8718700749205790830e2", "5.3941960214247511077e3", "2.1213794301586595867e4", "3.9307895800092710610e4", "2.8729085735721942674e4", "5.2264952788528545610e3")
_C = ("1.42343711074968357734e0", "4.63033784615654529590e0", "5.76949722146069140550e0", "3.64784832476320460504e0", "1.27045825245236838258e0", "2.41780725177450611770e-1", "2.27238449892691845833e-2", "7.74545014278341407640e-4")
_D = ("1e0", "2.05319162663775882187e0", "1.67638483018380384940e0", "6.89767334985100004550e-1", "1.48103976427480074590e-1", "1.51986665636164571966e-2", "5.47593808499534494600e-4", "1.05075007164441684324e-9")

# Hart's rational form of the tail, highest power first.
_P = ("3.52624965998911e-2", "7.00383064443688e-1", "6.37396220353165e0", "3.3912866078383e1", "1.12079291497871e2", "2.21213596169931e2", "2.20206867912376e2")
_Q = ("8.83883476483184e-2", "1.75566716318264e0", "1.6064177579207e1", "8.67807322029461e1", "2.96564248779674e2", "6.37333633378831e2", "7.93826512519948e2", "4.40413735824752e2")


def _horner(terms, x: str) -> str:
    """Terms by falling power."""
    out = terms[0]
    for t in terms[1:]:
        out = f"({out} * {x} + {t})"
    return out


def norm_ppf(p: str, clamp: str = "1e-6") -> str:
    """Inverse normal of p, held between clamp and 1 - clamp."""
    c = f"least(greatest(cast({p} as double), {clamp}), 1e0 - {clamp})"
    q, r1 = f"({c} - 0.5e0)", f"(0.180625e0 - ({c} - 0.5e0) * ({c} - 0.5e0))"
    r2 = f"(sqrt(-ln(least({c}, 1e0 - {c}))) - 1.6e0)"
    middle = f"{q} * {_horner(_A[::-1], r1)} / {_horner(_B[::-1], r1)}"
    tail = f"{_horner(_C[::-1], r2)} / {_horner(_D[::-1], r2)}"
    return f"(CASE WHEN abs({q}) <= 0.425e0 THEN {middle} WHEN {q} < 0e0 THEN -({tail}) ELSE {tail} END)"


def norm_cdf(z: str) -> str:
    """Normal distribution function, for |z| below 7; 0 or 1 beyond."""
    x = f"abs(cast({z} as double))"
    tail = f"(CASE WHEN {x} > 7e0 THEN 0e0 ELSE exp(-{x} * {x} / 2e0) * {_horner(_P, x)} / {_horner(_Q, x)} END)"
    return f"(CASE WHEN {z} > 0 THEN 1e0 - {tail} ELSE {tail} END)"
