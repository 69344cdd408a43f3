"""Feed items and price records derived from captured news feeds and procurement packages."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions import dates, html
from headwater.functions.rules import extract_name, first_in_list, first_match
from headwater.functions.text import contains_term, fold_search, has_text, let, matched_terms, plain_fold, raw_contains, shorten_spaceless, strip_suffix
from headwater.operators.dedup import first_seen

#: Rules of the client's kind, first match wins; a key may hit within words.
CLIENT_KINDS = (
    ("sekolah", ("sekolah", "siswa", "murid", " sd ", " smp ", " sma ", " smk ", "madrasah", "santri", "pondok pesantren")),
    ("bumn", ("bumn", "pln", "pertamina", "pt kai", "kereta api indonesia", "telkom", "pelindo", "bulog", "antam", "pgn", "angkasa pura", "pupuk indonesia", "bank mandiri", "bri ", "bni ", "persero")),
    (
        "pemerintah",
        (
            "dinas", "pemkab", "pemkot", "pemprov", "pemda", "kementerian", "kemenag", "kemendik", "pakaian dinas", "pdh", "pdl", "asn", "dprd", "polres", "polda", "polri", "tni", "kodim", "korem",
            "kelurahan", "kecamatan", "bupati", "wali kota", "walikota", "gubernur", "satpol", "sekretariat daerah", "setda", "bkpsdm", "kejaksaan", "pengadilan", "kpu", "bawaslu", "linmas",
        ),
    ),
    ("swasta", ("perusahaan", "pabrik", "hotel", "rumah sakit swasta", "karyawan pt")),
)
#: Rules of an event's category and segment.
CATEGORIES = (
    ("lari", ("fun run", "run for fun", "funrun", "marathon", "half marathon", "10k", "5k", "lari", "jalan sehat", "trail run", "night run", "color run")),
    ("gathering", ("gathering", "family day", "outing", "capacity building")),
    ("hut", ("hut ", "ulang tahun", "anniversary", "dies natalis", "harlah")),
)
SEGMENTS = (
    ("sekolah", ("sekolah", "kampus", "universitas", "mahasiswa", "siswa", "dies natalis")),
    (
        "pemerintah_bumn",
        (
            "bumn", "pemkab", "pemkot", "pemprov", "pemda", "dinas", "kementerian", "pln", "pertamina", "telkom", "bank indonesia", "pemerintah", "polres", "polda", "tni", "kodim",
            "hut ri", "hut kota", "hut kabupaten",
        ),
    ),
    ("korporat", ("perusahaan", "karyawan", "kantor", "pt ", "corporate", "bank ", "hotel")),
    ("komunitas", ("komunitas", "community", "runner", "pelari")),
)
#: Cities in the order in which they are looked for.
CITIES = (
    "Jakarta", "Surabaya", "Bandung", "Medan", "Semarang", "Makassar", "Palembang", "Tangerang", "Depok", "Bekasi", "Bogor", "Yogyakarta", "Jogja", "Solo", "Surakarta", "Malang", "Denpasar", "Bali",
    "Balikpapan", "Banjarmasin", "Pontianak", "Manado", "Padang", "Pekanbaru", "Batam", "Lampung", "Cirebon", "Purwokerto", "Magelang", "Salatiga", "Kediri", "Jember", "Banyuwangi", "Mandalika",
    "Lombok", "Labuan Bajo", "Bromo", "Borobudur",
)
#: Patterns of names of institutions and organisers, with the words that end a name.
INSTITUTIONS = (
    r"\b(Dinas [A-Z][A-Za-z]*(?: [A-Za-z][a-z]+){0,4})",
    r"\b(Kementerian [A-Z][A-Za-z]*(?: [A-Za-z][a-z]+){0,4})",
    r"\b(Pem(?:kab|kot|prov|da) [A-Z][a-z]+(?: [A-Z][a-z]+)?)",
    r"\b(Pemerintah (?:Kabupaten|Kota|Provinsi|Daerah) [A-Z][a-z]+(?: [A-Z][a-z]+)?)",
    r"\b((?:Kabupaten|Kota|Provinsi) [A-Z][a-z]+(?: [A-Z][a-z]+)?)",
    r"\b(DPRD [A-Z][a-z]+(?: [A-Z][a-z]+)?)",
    r"\b(Pol(?:res|da|sek) [A-Z][a-z]+(?: [A-Z][a-z]+)?)",
    r"\b(PT\.? [A-Z][A-Za-z]+(?: [A-Z][A-Za-z()]+){0,3})",
    r"\b(Setda [A-Z][a-z]+(?: [A-Z][a-z]+)?)",
    r"\b(Kejaksaan (?:Negeri|Tinggi) [A-Z][a-z]+)",
)
INSTITUTION_STOPS = (
    "kembali", "bakal", "akan", "segera", "larang", "minta", "siap", "siapkan", "gratis", "beri", "berikan", "bagikan", "salurkan", "gelar", "resmi", "mulai", "wajib", "belum", "sudah", "jadi", "buka",
    "dorong", "usul", "kaji", "tunda", "batal", "batalkan", "ingatkan", "sebut", "klaim", "janji", "janjikan", "pastikan", "cek", "sorot", "soroti", "sidak", "terima", "serahkan", "anggarkan",
    "alokasikan", "imbau", "tegaskan", "ancam", "copot", "target", "targetkan", "lelang", "lelangkan", "tender", "umumkan", "rilis", "rencanakan", "hingga", "usai", "soal", "terkait", "disorot",
    "dikritik", "didesak", "diminta", "tanggapi", "klarifikasi", "beli", "dinilai", "molor", "bupati",
)
ORGANISERS = (
    r"\b(PT\.? [A-Z][A-Za-z]+(?: [A-Z][A-Za-z()]+){0,3})",
    r"\b(Pem(?:kab|kot|prov) [A-Z][a-z]+(?: [A-Z][a-z]+)?)",
    r"\b(Bank [A-Z][A-Za-z]+(?: [A-Z][a-z]+)?)",
    r"\b(Komunitas [A-Z][A-Za-z]+(?: [A-Z][a-z]+){0,2})",
    r"\b(Universitas [A-Z][a-z]+(?: [A-Z][a-z]+)?)",
)
ORGANISER_STOPS = (
    "gelar", "gelaran", "sukses", "ajak", "adakan", "hadirkan", "kembali", "siap", "resmi", "buka", "umumkan", "rilis", "dukung", "sponsori", "ramaikan", "meriahkan", "hingga", "usai", "bakal", "akan",
    "segera",
)
#: Words of which a package's title must hold one.
PACKAGE_TERMS = ("seragam", "pakaian dinas", "wearpack", "batik dinas", "pdh", "pdl", "kain seragam")
#: Hints of official news, the first group with a term wins.
HINTS = (
    ("FACILITY_OPENING_CANDIDATE", ("pabrik baru", "fasilitas baru", "mulai beroperasi", "resmi beroperasi", "mulai produksi", "pembangunan pabrik", "konstruksi pabrik", "pembukaan pabrik", "grand opening", "cabang baru", "gerai baru")),
    (
        "BUSINESS_EXPANSION_CANDIDATE",
        ("ekspansi pabrik", "ekspansi industri", "perluasan fasilitas", "penambahan kapasitas", "peningkatan kapasitas produksi", "tambah kapasitas produksi", "menambah kapasitas produksi", "perluasan industri", "investasi fasilitas"),
    ),
    ("MASS_RECRUITMENT_CANDIDATE", ("rekrutmen massal", "membuka lowongan", "penerimaan karyawan", "penerimaan pegawai", "penambahan karyawan", "open recruitment", "hiring", "membutuhkan pekerja")),
)


def clean_title(title: Column, media: Column) -> Column:
    """A feed title without its tail; one without spaces is cut after 80 characters."""
    return shorten_spaceless(strip_suffix(F.btrim(title), media_tail(media)))


def media_tail(media: Column) -> Column:
    return F.coalesce(F.btrim(media), F.lit(""))


def client_kind(title: Column) -> Column:
    return first_match(title, CLIENT_KINDS, "tidak_diketahui", raw_contains)


def event_category(title: Column) -> Column:
    return first_match(title, CATEGORIES, "lainnya", partial(raw_contains, pad=False))


def event_segment(title: Column) -> Column:
    return first_match(title, SEGMENTS, "tidak_diketahui", raw_contains)


def _arrived(rss: DataFrame, source_name: str) -> DataFrame:
    rows = rss.withColumn("title", clean_title(F.col("title"), F.col("source"))).where(has_text(F.col("title")))
    named = F.when(has_text(F.col("source")), F.concat(F.lit(f"{source_name} ("), F.btrim("source"), F.lit(")"))).otherwise(source_name)
    published = F.date_format(dates.parse_rfc822(F.col("pub_date")), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    rows = rows.withColumn("sumber", named).withColumn("published", published).withColumn("link", F.coalesce(F.btrim("link"), F.lit("")))
    return first_seen(rows, F.sha2(plain_fold(F.col("title")), 256), [F.col("kw_pos"), F.col("pos")])


def tender_items(rss: DataFrame, source_name: str = "google_news_rss") -> DataFrame:
    """Tender items of feed rows (keyword, kw_pos, pos, title, link, pub_date, source): the first arrival of each folded title.

    Blank titles are left out; a date that does not parse is null. Newest first is the reader's order:
    ``orderBy(published desc nulls last, kw_pos, pos)``.
    """
    t = F.col("title")
    return _arrived(rss, source_name).select(
        "keyword", t.alias("judul"), extract_name(t, INSTITUTIONS, INSTITUTION_STOPS).alias("instansi_terdeteksi"), client_kind(t).alias("jenis_klien_tebakan"), "link", "sumber", "published", "kw_pos", "pos"
    )


def event_items(rss: DataFrame, source_name: str = "google_news_rss") -> DataFrame:
    """Event items of feed rows, as ``tender_items``; the contact stays null."""
    t = F.col("title")
    return _arrived(rss, source_name).select(
        t.alias("nama_event"), dates.event_date(t).alias("tanggal"), first_in_list(t, CITIES).alias("lokasi"), event_category(t).alias("kategori"), extract_name(t, ORGANISERS, ORGANISER_STOPS).alias("penyelenggara"),
        F.lit(None).cast("string").alias("kontak_resmi"), F.col("link").alias("link_resmi"), "sumber", event_segment(t).alias("segmen"), "keyword", "published", "kw_pos", "pos",
    )


#: Fields of a release that ``price_records`` reads; amounts may be numbers or objects with an amount, so they stay variants.
RELEASE = (
    "struct<ocid:string,date:string,tender:struct<title:string,value:variant>,buyer:struct<name:string>,awards:array<struct<value:variant>>,planning:struct<budget:struct<amount:variant>>>"
)


def amount(node: Column) -> Column:
    """A number, or the number under ``amount`` of an object; anything else is null, digits within a string included."""
    numeric = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
    inner = F.try_variant_get(node, "$.amount", "variant")
    return F.when(F.schema_of_variant(node).rlike(numeric), F.try_variant_get(node, "$", "double")).when(F.schema_of_variant(inner).rlike(numeric), F.try_variant_get(inner, "$", "double"))


def price_records(releases: DataFrame, terms=PACKAGE_TERMS) -> DataFrame:
    """Indicative prices of the packages whose title holds a term: budget, estimate and the first award that has a value."""
    title = F.btrim("tender.title")
    keep = F.lit(False)
    for t in terms:
        keep = keep | raw_contains(title, t, pad=False)
    awards = F.filter(F.transform("awards", lambda a: amount(a["value"])), lambda v: v.isNotNull())
    return releases.where(has_text(title) & keep).select(
        "ocid", title.alias("judul_paket"), F.col("buyer.name").alias("instansi"), F.nullif(F.substring("date", 1, 4), F.lit("")).alias("tahun"), amount(F.col("planning.budget.amount")).alias("nilai_pagu"),
        amount(F.col("tender.value")).alias("nilai_hps"), F.try_element_at(awards, F.lit(1)).alias("nilai_penetapan_pemenang"),
    )


def source_hint(title: Column, excerpt: Column) -> Column:
    """Struct (code, matched_terms, evidence_excerpt, human_review_required) of the first group of hints with a term in title or excerpt."""
    title, excerpt = F.coalesce(title, F.lit("")), F.coalesce(excerpt, F.lit(""))
    none = _hint(F.lit("OTHER_OFFICIAL_NEWS"), F.array().cast("array<string>"), F.when(excerpt != "", excerpt).otherwise(title))

    def first(folded: Column) -> Column:
        t, x = folded["t"], folded["x"]

        def hint(code: str, found: Column) -> Column:
            in_title = F.contains(F.concat(F.lit(" "), t, F.lit(" ")), F.concat(F.lit(" "), F.try_element_at(found, F.lit(1)), F.lit(" ")))
            return F.when(F.size(found) > 0, _hint(F.lit(code), found, F.when(in_title, title).otherwise(excerpt)))

        made = []
        for code, terms in HINTS:
            found = matched_terms(None, terms, lambda _, term: contains_term(t, term) | contains_term(x, term))
            made.append(let(found, partial(hint, code)))
        return F.coalesce(*made, none)

    # the lambda binds the folded texts, which would be made anew for every term
    both = F.struct(fold_search(html.clean_text(title)).alias("t"), fold_search(html.clean_text(excerpt)).alias("x"))
    return let(both, first)


def _hint(code: Column, terms: Column, evidence: Column) -> Column:
    return F.struct(code.alias("code"), terms.alias("matched_terms"), F.substring(html.clean_text(evidence), 1, 500).alias("evidence_excerpt"), F.lit(True).alias("human_review_required"))
