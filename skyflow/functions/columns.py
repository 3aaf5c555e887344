"""Scalar columns: times, fluxes, identifiers, band names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Band numbers and letters, default filter of combined bands, survey numbers of master ids.
BANDS = {1: "g", 2: "r", 3: "i", 0: None, 12: "gr"}
SURVEY_NUMBERS = {"ZTF": 1, "LSST": 2}
ZERO_MAG = 100.0


def mjd(jd: Column) -> Column:
    return jd - 2400000.5


def isclose(a: Column, b, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    b = b if isinstance(b, Column) else F.lit(float(b))
    return F.abs(a - b) <= atol + rtol * F.abs(b)


def clean(x: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def output_name(name: Column, fid: Column) -> Column:
    """Feature name of stored records: - and / as _, and the band's number behind it (_1, _2, _12; none for 0)."""
    number = band_number(fid)
    plain = F.translate(name, "-/", "__")
    return F.when(number == 0, plain).otherwise(F.concat_ws("_", plain, number.cast("string")))


def rate_name(name: Column) -> Column:
    """Names of power rates written 1_4 become 1/4."""
    return F.regexp_replace(name, r"([0-9])_([0-9])$", "$1/$2")


def clean_for_output(df, value: str = "value", name: str = "name", fid: str = "fid"):
    """Long features with output names; NaN and infinities are null."""
    return df.withColumns({value: clean(F.col(value)), name: output_name(F.col(name), F.col(fid))})


def band_letter(fid: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in BANDS.items():
        if v:
            out = F.when(fid == k, v).otherwise(out)
    return out


def band_number(band: Column) -> Column:
    out = F.lit(0)
    for name, k in (("g", 1), ("r", 2), ("i", 3), ("g,r", 12)):
        out = F.when(band == name, k).otherwise(out)
    return out


def flux_to_mag(flux: Column, uncertainty: Column, zero_point: Column) -> tuple[Column, Column]:
    """Difference flux to (mag, e_mag); the missing marker -99999 and null become 100."""
    scaled = F.pow(F.lit(10.0), (8.9 - zero_point) / 2.5) * 1e6
    bad = flux.isNull() | uncertainty.isNull() | isclose(flux, -99999) | isclose(uncertainty, -99999) | (flux == 0)
    return F.when(bad, ZERO_MAG).otherwise(-2.5 * F.log10(F.abs(flux) * scaled) + 23.9), F.when(bad, ZERO_MAG).otherwise(1.0857 * uncertainty / F.abs(flux))


def mag_to_flux(mag: Column, e_mag: Column, sign: Column) -> tuple[Column, Column]:
    """Magnitude to signed difference flux (uJy) and its error."""
    flux = F.pow(F.lit(10.0), -(mag - 23.9) / 2.5)
    return flux * sign, e_mag * flux * F.log(F.lit(10.0)) / 2.5


def aid_number(ra: Column, dec: Column) -> Column:
    """19-digit number from the sexagesimal digits of a position; ra wraps at most once."""
    ra = F.when(ra < 0, ra + 360).when(ra > 360, ra - 360).otherwise(ra)
    h, d = ra / 15, F.abs(dec)
    i = lambda c: F.floor(c).cast("long")
    hh, dd = i(h), i(d)
    m, am = (h - hh) * 60, (d - dd) * 60
    s, sa = (m - i(m)) * 60, (am - i(am)) * 60
    ff, fa = i((s - i(s)) * 100), i((sa - i(sa)) * 10)
    return F.lit(10**18) + hh * 10**16 + i(m) * 10**14 + i(s) * 10**12 + ff * 10**10 + F.when(dec >= 0, 10**9).otherwise(0) + dd * 10**7 + i(am) * 10**5 + i(sa) * 1000 + fa * 100


def aid_encode(n: Column) -> Column:
    """Base-26 lower-case letters, most significant first; 0 and null give the empty string and null."""
    powers = F.filter(F.array(*(F.lit(26**k) for k in range(13, -1, -1))), lambda p: n >= p)
    return F.array_join(F.transform(powers, lambda p: F.char((F.call_function("div", n, p) % 26 + 97).cast("int"))), "")


def aid_decode(code: Column) -> Column:
    return F.aggregate(F.split(code, ""), F.lit(0).cast("long"), lambda acc, c: F.when(c == "", acc).otherwise(acc * 26 + (F.ascii(c) - 97)))


def valid_oid(oid: Column) -> Column:
    return F.coalesce(oid.rlike("^ZTF[0-9]{2}[a-z]{7}$"), F.lit(False))


def masterid_encode(oid: Column, survey: str = "ZTF") -> Column:
    """64-bit id: the survey's number in the top 8 of 63 bits, then year and letters in base 26; null if invalid."""
    n = F.substring(oid, 4, 2).cast("long") * 26**7
    for k in range(7):
        n = n + (F.ascii(F.substring(oid, 6 + k, 1)) - 97).cast("long") * 26 ** (6 - k)
    return F.when(valid_oid(oid), F.lit(SURVEY_NUMBERS[survey] << 55) + n)


def masterid_decode(master: Column) -> tuple[Column, Column]:
    """(survey, oid) of a master id."""
    number, rest = F.shiftright(master, 55), master.bitwiseAND((1 << 55) - 1)
    survey = F.lit(None).cast("string")
    for name, k in SURVEY_NUMBERS.items():
        survey = F.when(number == k, name).otherwise(survey)
    letters = [F.char((F.call_function("div", rest, F.lit(26 ** (6 - k))) % 26 + 97).cast("int")) for k in range(7)]
    year = F.call_function("div", rest, F.lit(26**7)) % 100
    return survey, F.when(number == SURVEY_NUMBERS["ZTF"], F.concat(F.lit("ZTF"), F.lpad(year.cast("string"), 2, "0"), *letters))


def jd_to_date(jd: Column) -> tuple[Column, Column, Column]:
    """(year, month, fractional day) of a Julian day."""
    days = jd - 2440587.5  # since 1970
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(days).cast("int"))
    return F.year(date), F.month(date), F.dayofmonth(date) + days - F.floor(days)


def geo_point(ra: Column, dec: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(ra - 180, dec).alias("coordinates"))


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance in arcsec (haversine)."""
    p1, p2 = F.radians(dec1), F.radians(dec2)
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(ra2 - ra1) / 2), 2)
    return F.degrees(2 * F.asin(F.sqrt(F.least(h, F.lit(1.0))))) * 3600


def missing(x: Column, marker: float = -9999.0) -> Column:
    return F.when(x == marker, None).otherwise(x)


def object_key(candid: Column) -> Column:
    """Storage key of a stamp: the reversed digits, so that keys spread."""
    return F.concat(F.reverse(candid.cast("string")), F.lit(".avro"))
