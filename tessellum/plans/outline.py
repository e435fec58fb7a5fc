"""Queries over the outline, references and rendering; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessellum.operators import grammar, iob, links, render, structure
from tessellum.operators.rejects import once
from tessellum.plans import document
from tessellum.plans.registry import Registry
from tessellum.schema import LEVELS
from tessellum.session import materialize
from tessellum.tables import table

LEVEL = "CASE type " + " ".join(f"WHEN '{t}' THEN {k}" for k, t in enumerate(LEVELS)) + " END"
ELEMENTS = f"els AS (SELECT DISTINCT fileid, el_id, type, titre, numero, debut, fin, page, {LEVEL} AS lvl FROM elements WHERE fileid IS NOT NULL AND el_id IS NOT NULL)"
PARENTS = ELEMENTS + """, parents AS (SELECT e.*, (SELECT max(p.el_id) FROM els p WHERE p.fileid = e.fileid AND p.el_id < e.el_id AND p.lvl < e.lvl) AS parent FROM els e)"""
PATHS = PARENTS.replace("els AS", "RECURSIVE els AS", 1) + """, paths AS (SELECT *, [type, coalesce(numero, '')] AS path FROM parents WHERE parent IS NULL
  UNION ALL SELECT e.*, p.path || [e.type, coalesce(e.numero, '')] FROM parents e JOIN paths p ON e.fileid = p.fileid AND e.parent = p.el_id)"""
TITLE = """CASE WHEN coalesce(titre, '') = '' THEN CASE WHEN coalesce(numero, '') = '' OR numero LIKE '\\_%' ESCAPE '\\' THEN type ELSE type || ' ' || numero END
  WHEN coalesce(numero, '') = '' OR numero LIKE '\\_%' ESCAPE '\\' THEN titre ELSE type || ' ' || numero || ': ' || titre END"""
query = Registry(els=ELEMENTS, parents=PARENTS, paths=PATHS, title=TITLE, words=document.WORDS, blocks=document.sql_blocks("seg"))
RE2 = lambda p: p.replace(r"\x85", r"\x{0085}").replace("'", "''")


def tidy(spark: SparkSession, d: str) -> DataFrame:
    """Each element once."""
    return table(spark, d, "elements").where("fileid IS NOT NULL AND el_id IS NOT NULL").drop("loaded_at").dropDuplicates(["fileid", "el_id"])


LEAD, TRAIL = RE2(structure.LEADING), RE2(structure.TRAILING)
query.views["els_zoned"] = f"""plain AS (SELECT DISTINCT fileid, el_id, type, titre, numero, {LEVEL} AS lvl FROM elements WHERE fileid IS NOT NULL AND el_id IS NOT NULL),
  els AS (SELECT * REPLACE (CASE WHEN type = 'Chapitre' AND row_number() OVER (PARTITION BY fileid, type ORDER BY el_id) = 2 THEN 'Des Milieux et zones du territoire' ELSE titre END AS titre) FROM plain)"""


def zone_chapters(spark: SparkSession, d: str) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("fileid", "type").orderBy("el_id"))
    return tidy(spark, d).withColumn("titre", F.when((F.col("type") == "Chapitre") & (nth == 2), "Des Milieux et zones du territoire").otherwise(F.col("titre")))


@query(
    f"""WITH {{els}}, cut AS (SELECT *, coalesce(titre, '') AS t, regexp_extract(coalesce(titre, ''), '{LEAD}', 0) AS lead, regexp_extract(coalesce(titre, ''), '{TRAIL}', 2) AS trail FROM els),
  named AS (SELECT *, CASE WHEN lead <> '' THEN regexp_extract(t, '{LEAD}', 1) || regexp_extract(t, '{LEAD}', 2) || regexp_extract(t, '{LEAD}', 3) WHEN trail <> '' THEN trail END AS n FROM cut)
  SELECT fileid, el_id, coalesce(n, '_' || CAST(sum(CASE WHEN n IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY fileid ORDER BY el_id) - 1 AS BIGINT)) AS numero_extrait,
    CASE WHEN lead <> '' THEN substr(t, length(lead) + 1) WHEN trail <> '' THEN regexp_extract(t, '{TRAIL}', 1) ELSE t END AS titre_nu FROM named"""
)
def extract_numero(spark, d):
    return structure.extract_numbers(tidy(spark, d)).select("fileid", "el_id", "numero_extrait", "titre_nu")


@query("WITH {els} SELECT fileid, el_id, debut, coalesce((SELECT arg_min(n.debut, n.el_id) FROM els n WHERE n.fileid = e.fileid AND n.el_id > e.el_id AND n.lvl <= e.lvl), -1) AS fin_calcule FROM els e")
def element_intervals(spark, d):
    return structure.close_intervals(tidy(spark, d)).select("fileid", "el_id", "debut", "fin_calcule")


@query("WITH {parents} SELECT fileid, el_id, parent FROM parents")
def element_parent(spark, d):
    return structure.find_parents(tidy(spark, d)).select("fileid", "el_id", "parent")


@query("WITH {paths} SELECT fileid, el_id, array_to_string(path, '/') AS path FROM paths")
def element_path(spark, d):
    return structure.ancestor_paths(tidy(spark, d)).select("fileid", "el_id", F.array_join("path", "/").alias("path"))


@query(
    r"""WITH docs AS (SELECT DISTINCT fileid, titre FROM bylaws WHERE titre IS NOT NULL),
  variants AS (SELECT fileid, titre FROM docs UNION ALL SELECT fileid || '#2', titre || ' numéro ' || (length(titre) + 1000) || '-2 bis' FROM docs UNION ALL SELECT fileid || '#3', titre || ' 12-' || length(titre) || '-AB' FROM docs UNION ALL SELECT fileid || '#4', 'Le règlement ' || (length(titre) + 100) || '-X du conseil' FROM docs)
  SELECT fileid, coalesce(nullif(regexp_extract(titre, '(?i)num[ée]ro\s+([0-9](?-i:[A-Z0-9-]+))', 1), ''), nullif(regexp_extract(titre, '(?i)r[èe]glement\s+([0-9](?-i:[A-Z0-9-]+))', 1), ''), nullif(regexp_extract(titre, '^.*?(\b[0-9]+-[0-9]+-[A-Z]+)$', 1), '')) AS numero,
    CASE WHEN regexp_matches(titre, '(?i)num[ée]ro\s+([0-9](?-i:[A-Z0-9-]+))') THEN regexp_replace(titre, '(?i)num[ée]ro\s+([0-9](?-i:[A-Z0-9-]+))', '')
      WHEN regexp_matches(titre, '(?i)r[èe]glement\s+([0-9](?-i:[A-Z0-9-]+))') THEN regexp_replace(titre, '((?i)r[èe]glement\s+)([0-9](?-i:[A-Z0-9-]+))', '\1') ELSE regexp_replace(titre, '\b[0-9]+-[0-9]+-[A-Z]+$', '') END AS titre_nu FROM variants"""
)
def doc_title(spark, d):
    docs = table(spark, d, "bylaws").select("fileid", "titre").where("titre IS NOT NULL").distinct()
    variants = F.array(
        F.struct("fileid", "titre"),
        F.struct(F.concat("fileid", F.lit("#2")).alias("fileid"), F.concat("titre", F.lit(" numéro "), F.length("titre") + 1000, F.lit("-2 bis")).alias("titre")),
        F.struct(F.concat("fileid", F.lit("#3")).alias("fileid"), F.concat("titre", F.lit(" 12-"), F.length("titre"), F.lit("-AB")).alias("titre")),
        F.struct(F.concat("fileid", F.lit("#4")).alias("fileid"), F.concat(F.lit("Le règlement "), F.length("titre") + 100, F.lit("-X du conseil")).alias("titre")),
    )
    number, title = structure.document_title(F.col("titre"))
    return docs.select(F.inline(variants)).select("fileid", number.alias("numero"), title.alias("titre_nu"))


@query(
    r"""WITH {els_zoned}, parents AS (SELECT e.*, (SELECT max(p.el_id) FROM els p WHERE p.fileid = e.fileid AND p.el_id < e.el_id AND p.lvl < e.lvl) AS parent FROM els e), top AS (SELECT fileid, min(el_id) AS c, arg_min(coalesce(numero, ''), el_id) AS cn FROM parents WHERE type = 'Chapitre' AND contains(lower(coalesce(titre, '')), 'milieux et zones') GROUP BY fileid),
  secs AS (SELECT e.*, e.fileid || '/Chapitre/' || cn || '/' || type || '/' || coalesce(numero, '') AS url FROM parents e JOIN top USING (fileid) WHERE parent = c AND NOT contains(lower(coalesce(titre, '')), 'dispositions')),
  subs AS (SELECT e.fileid, e.el_id, e.titre, s.url || '/' || e.type || '/' || coalesce(e.numero, '') AS url FROM parents e JOIN secs s ON e.fileid = s.fileid AND e.parent = s.el_id),
  found AS (SELECT fileid, 'categorie_milieu' AS kind, el_id, regexp_extract(titre, '^\s*(\S+)\s*[-–—]\s*(.*)', 1) AS code, regexp_extract(titre, '^\s*(\S+)\s*[-–—]\s*(.*)', 2) AS titre, url FROM secs
    UNION ALL SELECT fileid, 'milieu', el_id, regexp_extract(titre, '^\s*(\S+)[-–—\s]+(.*)', 1), regexp_extract(titre, '^\s*(\S+)[-–—\s]+(.*)', 2), url FROM subs)
  SELECT fileid, kind, code, arg_max(titre, el_id) AS titre, arg_max(url, el_id) AS url FROM found WHERE code <> '' GROUP BY ALL"""
)
def zonage(spark, d):
    """Zones of the documents; as no chapter of the tables has their title, each document's second chapter is called so here."""
    return structure.zones(zone_chapters(spark, d))


@query("WITH {els} SELECT fileid, el_id, {title} AS affiche FROM els")
def display_title(spark, d):
    return tidy(spark, d).select("fileid", "el_id", structure.display_title(F.col("type"), F.col("numero"), F.col("titre")).alias("affiche"))


@query(
    """WITH docs AS (SELECT fileid, max(CASE WHEN numero IS NULL THEN coalesce(titre, '') ELSE numero || ': ' || coalesce(titre, '') END) AS k FROM bylaws WHERE fileid IS NOT NULL GROUP BY fileid),
  keyed AS (SELECT fileid, k, array_to_string(list_transform(regexp_extract_all(k, '[0-9]+|[^0-9]+'), lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN lpad(x, 20, '0') ELSE x END), '') AS s FROM docs)
  SELECT fileid, k, s FROM keyed"""
)
def natural_sort(spark, d):
    """Documents with the key that sorts them by number and title, numbers by value."""
    k = F.when(F.col("numero").isNull(), F.coalesce("titre", F.lit(""))).otherwise(F.concat("numero", F.lit(": "), F.coalesce("titre", F.lit(""))))
    docs = table(spark, d, "bylaws").where("fileid IS NOT NULL").groupBy("fileid").agg(F.max(k).alias("k"))
    return docs.withColumn("s", structure.natural_key(F.col("k")))


@query(
    """WITH {paths}, deep AS (SELECT *, CAST(len(path) / 2 AS INTEGER) AS depth, {title} AS label FROM paths), looked AS (SELECT *, coalesce(lead(depth) OVER (PARTITION BY fileid ORDER BY el_id), 1) AS nxt,
    '<a href="' || fileid || '/' || array_to_string(CASE WHEN type IN ('Article', 'Annexe') THEN [type, coalesce(numero, '')] ELSE path END, '/') || '/index.html">' || label || '</a>' AS link FROM deep),
  marked AS (SELECT *, CASE WHEN nxt <= depth THEN '<li class="leaf ' || type || '">' || link || '</li>' ELSE '<li class="node ' || type || '"><details><summary>' || label || '</summary><ul><li>' || link || '</li>' END || repeat('</ul></details></li>', greatest(depth - nxt, 0)) AS html FROM looked)
  SELECT fileid, string_agg(html, '' ORDER BY el_id) AS html FROM marked GROUP BY fileid"""
)
def doc_tree(spark, d):
    return structure.outline_html(tidy(spark, d))


@query("WITH {parents}, named AS (SELECT *, {title} AS label FROM parents) SELECT fileid, parent, type, count(*) AS n, string_agg(label, '|' ORDER BY el_id) AS titles FROM named GROUP BY fileid, parent, type")
def section_index(spark, d):
    return structure.section_index(tidy(spark, d))


@query("WITH {paths} SELECT fileid, el_id, fileid || '/' || array_to_string(CASE WHEN type IN ('Article', 'Annexe') THEN [type, coalesce(numero, '')] ELSE path END, '/') || '/index.html' AS page_path FROM paths")
def page_paths(spark, d):
    return structure.page_paths(tidy(spark, d)).select("fileid", "el_id", "page_path")


@query(
    """WITH {paths}, tags AS (SELECT fileid, el_id, type AS tagstack FROM parents WHERE parent IS NULL UNION ALL SELECT e.fileid, e.el_id, t.tagstack || ';' || e.type FROM parents e JOIN tags t ON e.fileid = t.fileid AND e.parent = t.el_id)
  SELECT fileid, el_id AS node, tagstack FROM tags"""
)
def tag_stack(spark, d):
    nodes = structure.find_parents(tidy(spark, d)).select("fileid", F.col("el_id").alias("node"), "parent", F.col("type").alias("tag"))
    return structure.tag_paths(nodes)


# References. White space is made plain first, as the two engines' classes for it differ.
SPACES = r"[\s\p{Z}]"
TEXTS = r"""texts AS (SELECT DISTINCT ref AS id, regexp_replace(texte, '[\s\p{Z}]', ' ', 'g') AS t FROM index_docs WHERE texte IS NOT NULL
  UNION ALL SELECT DISTINCT -el_id, CASE el_id % 6 WHEN 0 THEN 'Voir les articles ' || el_id || ', ' || (el_id + 2) || ' et ' || (el_id + 5) || ' de la Loi sur l''aménagement et l''urbanisme (L.R.Q., c. A-19.1).'
    WHEN 1 THEN 'Selon l''article ' || el_id || '.2 du règlement de zonage ' || el_id || '-' || page || ', ailleurs.'
    WHEN 2 THEN 'Les types de milieux T' || (el_id % 7) || '.1, T' || (el_id % 5) || '.2 et T3.3 du règlement de lotissement.'
    WHEN 3 THEN 'le chapitre XI ou la section ' || el_id || ' du chapitre IV du Règlement sur les permis et certificats'
    WHEN 4 THEN 'article 12 du Code civil; loi sur les cités et villes; article ' || el_id || ' du Règlement sur les exploitations (c. Q-2, r. ' || page || ')'
    ELSE 'La Loi sur la qualité de l''environnement (chapitre Q-2) et l''annexe ' || el_id || ' de la loi.' END FROM elements WHERE el_id IS NOT NULL)"""


def texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts with references: the indexed ones, and one made of each element's number."""
    pages = table(spark, d, "index_docs").where("texte IS NOT NULL").select(F.col("ref").alias("id"), F.regexp_replace("texte", SPACES, " ").alias("t")).distinct()
    e, p = F.col("el_id"), F.col("page")
    forms = [
        F.concat(F.lit("Voir les articles "), e, F.lit(", "), e + 2, F.lit(" et "), e + 5, F.lit(" de la Loi sur l'aménagement et l'urbanisme (L.R.Q., c. A-19.1).")),
        F.concat(F.lit("Selon l'article "), e, F.lit(".2 du règlement de zonage "), e, F.lit("-"), p, F.lit(", ailleurs.")),
        F.concat(F.lit("Les types de milieux T"), e % 7, F.lit(".1, T"), e % 5, F.lit(".2 et T3.3 du règlement de lotissement.")),
        F.concat(F.lit("le chapitre XI ou la section "), e, F.lit(" du chapitre IV du Règlement sur les permis et certificats")),
        F.concat(F.lit("article 12 du Code civil; loi sur les cités et villes; article "), e, F.lit(" du Règlement sur les exploitations (c. Q-2, r. "), p, F.lit(")")),
        F.concat(F.lit("La Loi sur la qualité de l'environnement (chapitre Q-2) et l'annexe "), e, F.lit(" de la loi.")),
    ]
    pick = F.coalesce(*[F.when(e % 6 == k, f) for k, f in enumerate(forms)])
    made = table(spark, d, "elements").where("el_id IS NOT NULL").select((-e).alias("id"), pick.alias("t")).distinct()
    return pages.unionByName(made)


REFERENCE = grammar.REFERENCE.replace("'", "''").replace(grammar.FIRST_LETTER, "")  # DuckDB's patterns have no look-ahead
LISTED = [tuple(x.replace("'", "''") for x in (grammar.SECTION, grammar.NUMBERS, grammar.NUMBER)), tuple(x.replace("'", "''") for x in (grammar.ZONE_WORDS, grammar.ZONES, grammar.ZONE))]
FOUND = rf"""cut AS (SELECT id, t, regexp_split_to_array(t, '(?i){REFERENCE}') AS between, regexp_extract_all(t, '(?i){REFERENCE}') AS found FROM texts),
  spots AS (SELECT id, t, CAST(coalesce(list_sum(list_transform(between[1:k], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(found[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS s, found[k] AS m FROM cut, unnest(range(1, len(found) + 1)) AS u(k)),
  heads AS (SELECT *, regexp_extract(m, '(?is)^({LISTED[0][0]}\s+)({LISTED[0][1]})(.*)$', 1) AS h1, regexp_extract(m, '(?is)^({LISTED[0][0]}\s+)({LISTED[0][1]})(.*)$', 2) AS b1, regexp_extract(m, '(?is)^({LISTED[0][0]}\s+)({LISTED[0][1]})(.*)$', 3) AS a1,
    regexp_extract(m, '(?is)^({LISTED[1][0]}\s+)({LISTED[1][1]})(.*)$', 1) AS h2, regexp_extract(m, '(?is)^({LISTED[1][0]}\s+)({LISTED[1][1]})(.*)$', 2) AS b2, regexp_extract(m, '(?is)^({LISTED[1][0]}\s+)({LISTED[1][1]})(.*)$', 3) AS a2 FROM spots),
  kinds AS (SELECT *, CASE WHEN regexp_matches(b1, ',|\s') THEN 1 WHEN regexp_matches(b2, ',|\s') THEN 2 ELSE 0 END AS kind FROM heads),
  bodies AS (SELECT id, t, s, m, kind, CASE kind WHEN 1 THEN h1 ELSE h2 END AS h, CASE kind WHEN 1 THEN b1 ELSE b2 END AS b, CASE kind WHEN 1 THEN a1 ELSE a2 END AS a,
    CASE kind WHEN 1 THEN regexp_extract_all(b1, '(?i){LISTED[0][2]}') ELSE regexp_extract_all(b2, '(?i){LISTED[1][2]}') END AS f,
    CASE kind WHEN 1 THEN regexp_split_to_array(b1, '(?i){LISTED[0][2]}') ELSE regexp_split_to_array(b2, '(?i){LISTED[1][2]}') END AS g FROM kinds),
  each AS (SELECT id, t, kind, s + length(h) + CAST(coalesce(list_sum(list_transform(g[1:k], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(f[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS start, f[k] AS q, h, a FROM bodies, unnest(range(1, len(f) + 1)) AS u(k) WHERE kind > 0),
  refs AS (SELECT id, start, start + length(q) AS stop, CASE kind WHEN 1 THEN regexp_replace(trim(h), 's$', '') || ' ' ELSE h END || q || a AS alt, q AS quote FROM each
    UNION ALL SELECT id, s, s + length(m), NULL, m FROM bodies WHERE kind = 0)"""
query.views |= {"texts": TEXTS, "refs": FOUND}


@query("WITH {texts}, {refs} SELECT id, start, stop, alt, quote FROM refs")
def match_links(spark, d):
    return links.references(texts(spark, d), "t", "id")


SITE = links.LAW_SITE
EXTERNAL = rf"""laws AS (SELECT *, coalesce(alt, quote) AS x FROM refs),
  read AS (SELECT *, trim(regexp_extract(x, '{grammar.CITED_LAW}', 1)) AS lq, regexp_matches(x, '{grammar.CITED_LAW}') AS has FROM laws),
  based AS (SELECT *, CASE WHEN has AND regexp_matches(lq, '{grammar.CITED_REGULATION}') THEN '{SITE}/rc/' || regexp_extract(lq, '{grammar.CITED_REGULATION}', 1) || ',%20r.%20' || regexp_extract(lq, '{grammar.CITED_REGULATION}', 2) || '%20'
    WHEN has THEN '{SITE}/lc/' || regexp_replace(lq, '\s+', '', 'g') {' '.join(f"WHEN contains(lower(x), '{w}') THEN '{SITE}/lc/{c}'" for w, c in links.KNOWN_LAWS)} END AS base FROM read)"""


@query("WITH {texts}, {refs}, " + EXTERNAL + r" SELECT id, start, CASE WHEN regexp_matches(x, '\barticle [\d\.]+') THEN base || '#se:' || replace(regexp_extract(x, '\barticle ([\d\.]+)', 1), '.', '_') ELSE base END AS url FROM based WHERE base IS NOT NULL")
def resolve_external(spark, d):
    refs = links.references(texts(spark, d), "t", "id")
    return once(refs, "url", links.resolve_external(F.coalesce("alt", "quote"))).select("id", "start", "url").where("url IS NOT NULL")


def sql_normal(text: str) -> str:
    edge = links.TITLE_EDGE.replace("'", "''")
    return rf"""trim(regexp_replace(replace(translate(regexp_replace(regexp_replace(trim(regexp_replace(lower({text}), '[\s\p{{Z}}]+', ' ', 'g')), '{grammar.TITLE_START}', ''), '\bpiia\b', 'plans d''implantation et d''intégration architecturale', 'g'), '‘’', ''''''), ', ', ' '), '\([^\)]+\)$', ''), '{edge}')"""


@query(f"SELECT DISTINCT titre, {sql_normal('titre')} AS normal FROM bylaws WHERE titre IS NOT NULL")
def normalize_title(spark, d):
    return table(spark, d, "bylaws").where("titre IS NOT NULL").select("titre", links.normalize_title(F.col("titre")).alias("normal")).distinct()


BYLAWS = """docs AS (SELECT fileid AS docpath, max(numero) AS numero, max(titre) AS titre, fileid AS ord FROM bylaws WHERE fileid IS NOT NULL GROUP BY fileid)"""


def register(spark: SparkSession, d: str) -> DataFrame:
    """By-laws by file, in the order of their names."""
    return table(spark, d, "bylaws").where("fileid IS NOT NULL").groupBy(F.col("fileid").alias("docpath")).agg(F.max("numero").alias("numero"), F.max("titre").alias("titre")).withColumn("ord", F.col("docpath"))


CITES = r"""cites AS (SELECT DISTINCT texte[1:0] || m AS text FROM (SELECT unnest(regexp_extract_all(regexp_replace(texte, '[\s\p{Z}]+', ' ', 'g'), 'règlement numéro [0-9-]+')) AS m, texte FROM index_docs)
  UNION SELECT 'au ' || titre || ' et ses annexes' FROM docs WHERE titre IS NOT NULL UNION SELECT 'le plan d''ensemble')"""


def citations(spark: SparkSession, d: str) -> DataFrame:
    """Texts that cite by-laws: those found in the index, and one made of each title."""
    found = table(spark, d, "index_docs").select(F.explode(F.regexp_extract_all(F.regexp_replace("texte", SPACES + "+", " "), F.lit("règlement numéro [0-9-]+"), F.lit(0))).alias("text"))
    made = register(spark, d).where("titre IS NOT NULL").select(F.concat(F.lit("au "), "titre", F.lit(" et ses annexes")).alias("text"))
    return found.union(made).union(spark.range(1).select(F.lit("le plan d'ensemble"))).distinct()


@query(
    "WITH " + BYLAWS + ", " + CITES + r""", read AS (SELECT text, regexp_matches(text, '(?i)règlement') AS cites, nullif(trim(regexp_extract(text, '(?i)règlement(?:[^\d]+((?-i:[\d\.A-Z-]+)))?', 1), ' .,;'), '') AS n, """ + sql_normal("text") + """ AS normal FROM cites),
  titles AS (SELECT t, max_by(docpath, ord) AS path, min(ord) AS ord FROM (SELECT *, """ + sql_normal("titre") + """ AS t FROM docs) WHERE t <> '' GROUP BY t),
  numbers AS (SELECT numero, max_by(docpath, ord) AS path FROM docs WHERE numero IS NOT NULL GROUP BY numero)
  SELECT text, CASE WHEN cites THEN coalesce((SELECT path FROM numbers WHERE numero = n), (SELECT arg_min(path, ord) FROM titles WHERE contains(normal, t))) END AS docpath FROM read"""
)
def resolve_bylaw(spark, d):
    return links.resolve_bylaws(citations(spark, d), register(spark, d)).select("text", "docpath")


@query(
    """WITH {paths}, refs AS (SELECT fileid, el_id, CASE type WHEN 'SousSection' THEN 'sous-section' ELSE lower(type) END || ' ' || numero AS text, CASE WHEN el_id % 3 = 0 THEN array_to_string(path, '/') WHEN el_id % 3 = 1 THEN 'Article/' || coalesce(numero, '') ELSE array_to_string(path[1:len(path) - 2], '/') END AS srcpath FROM paths WHERE regexp_full_match(numero, '[0-9.]+')),
  read AS (SELECT *, CASE WHEN text LIKE 'sous%' THEN 'SousSection' ELSE upper(text[1]) || split_part(text, ' ', 1)[2:] END AS kind, trim(split_part(text, ' ', 2), '.') AS n, string_split(srcpath, '/') AS src FROM refs),
  origin AS (SELECT r.*, (SELECT arg_min(p.path[1:len(p.path) - 2], p.el_id) FROM paths p WHERE p.fileid = r.fileid AND p.type = 'Article' AND p.numero = r.src[2]) AS place FROM read r),
  full_ AS (SELECT *, CASE WHEN kind IN ('Chapitre', 'Article', 'Annexe') OR src[1] = 'Annexe' OR (contains('Article', src[1]) AND len(src) = 1) THEN [kind, n]
    ELSE (CASE WHEN contains('Article', src[1]) THEN coalesce(place, []) ELSE src END)[1:coalesce(nullif(list_position(CASE WHEN contains('Article', src[1]) THEN coalesce(place, []) ELSE src END, kind), 0), 1000) - 1] || [kind, n] END AS dest FROM origin),
  there AS (SELECT *, EXISTS (SELECT 1 FROM paths p WHERE p.fileid = f.fileid AND (p.path = f.dest OR (p.type IN ('Article', 'Annexe') AND [p.type, coalesce(p.numero, '')] = f.dest))) AS ok, list_filter(src, lambda x: x <> '') AS s, list_filter(dest, lambda x: x <> '') AS e FROM full_ f),
  common AS (SELECT *, len(list_filter(range(1, least(len(s), len(e)) + 1), lambda i: s[1:i] = e[1:i])) AS k FROM there)
  SELECT fileid, el_id, CASE WHEN ok THEN coalesce(nullif(array_to_string(list_transform(range(len(s) - k), lambda x: '..') || e[k + 1:], '/'), ''), '.') || '/index.html' END AS href FROM common"""
)
def resolve_internal(spark, d):
    """References to each element by its own words, from its own page, from an article and from its parent's page."""
    e = structure.ancestor_paths(tidy(spark, d))
    name = F.when(F.col("type") == "SousSection", "sous-section").otherwise(F.lower("type"))
    src = F.when(F.col("el_id") % 3 == 0, F.array_join("path", "/")).when(F.col("el_id") % 3 == 1, F.concat(F.lit("Article/"), F.coalesce("numero", F.lit("")))).otherwise(F.array_join(F.slice("path", F.lit(1), F.size("path") - 2), "/"))
    refs = e.where(F.col("numero").rlike(r"^[0-9.]+\z")).select("fileid", "el_id", F.concat(name, F.lit(" "), "numero").alias("text"), src.alias("srcpath"))
    return links.resolve_internal(refs, register(spark, d), e).select("fileid", "el_id", "href")


@query(
    r"""WITH {texts}, codes AS (SELECT 'T' || (el_id % 7) || '.1' AS code, max('doc/Chapitre/1/Section/' || el_id) AS url FROM elements WHERE el_id IS NOT NULL GROUP BY 1),
  named AS (SELECT id, regexp_extract(t, '(?i)\btypes?\s+des?\s+milieux?\s+([\dA-Z]+\.\d)', 1) AS code FROM texts)
  SELECT id, '../../../' || url || '/index.html' AS zone_href FROM named JOIN codes USING (code)"""
)
def resolve_zonage(spark, d):
    zones = table(spark, d, "elements").where("el_id IS NOT NULL").select(F.concat(F.lit("T"), F.col("el_id") % 7, F.lit(".1")).alias("code"), F.concat(F.lit("doc/Chapitre/1/Section/"), "el_id").alias("url"))
    rows = texts(spark, d).withColumn("srcpath", F.lit("Article/1"))
    return links.resolve_zone(rows, zones, "t").where("zone_href IS NOT NULL").select("id", "zone_href")


# Rendering.
TAG = lambda t, c: "CASE " + c + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in t.items()) + " END"
BLOCK = f"""CASE {TAG(render.BLOCK_TAGS, 'type')} WHEN '' THEN '' WHEN 'img' THEN '<img alt="' || text || '" src="page' || page || '-' || concat_ws(',', x0, top, x1, bottom) || '.jpg"><br>'
  ELSE '<' || {TAG(render.BLOCK_TAGS, 'type')} || '>' || text || '</' || {TAG(render.BLOCK_TAGS, 'type')} || '>' END"""


def no_links():
    return F.lit(None).cast("array<struct<start:int,end:int,href:string>>")


@query("WITH {words}, {blocks} SELECT fileid, first_idx, " + BLOCK + " AS html FROM blocks WHERE type IN (" + ", ".join(f"'{t}'" for t in render.BLOCK_TAGS) + ")")
def bloc_html(spark, d):
    rows = iob.group_blocks(document.tidy(spark, d)).where(F.col("type").isin(*render.BLOCK_TAGS))
    return rows.select("fileid", "first_idx", render.block_html(F.col("type"), F.col("text"), no_links()).alias("html"))


def numbered_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks with number and bare title where they are headings."""
    blocks = materialize(iob.group_blocks(document.tidy(spark, d)), "blocks")
    return structure.extract_numbers(blocks, "text", "first_idx", heading=F.col("type").isin(*LEVELS)).withColumnRenamed("numero_extrait", "numero")


@query(
    f"""WITH {{words}}, {{blocks}}, heads AS (SELECT *, regexp_extract(text, '{LEAD}', 0) AS lead, regexp_extract(text, '{TRAIL}', 2) AS trail FROM blocks WHERE type IN ({', '.join(f"'{t}'" for t in LEVELS)})),
  numbered AS (SELECT *, CASE WHEN lead <> '' THEN regexp_extract(text, '{LEAD}', 1) || regexp_extract(text, '{LEAD}', 2) || regexp_extract(text, '{LEAD}', 3) WHEN trail <> '' THEN trail END AS n,
    CASE WHEN lead <> '' THEN substr(text, length(lead) + 1) WHEN trail <> '' THEN regexp_extract(text, '{TRAIL}', 1) ELSE text END AS titre_nu FROM heads),
  known AS (SELECT fileid, first_idx, titre_nu, coalesce(n, '_' || CAST(sum(CASE WHEN n IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY fileid ORDER BY first_idx) - 1 AS BIGINT)) AS numero FROM numbered),
  items AS (SELECT b.*, k.titre_nu, k.numero, {LEVEL.replace('type', 'b.type')} AS lvl, row_number() OVER (PARTITION BY b.fileid ORDER BY b.first_idx) AS seq FROM blocks b LEFT JOIN known k USING (fileid, first_idx)),
  ends AS (SELECT i.*, (SELECT min(n.seq) FROM items n WHERE n.fileid = i.fileid AND n.seq > i.seq AND n.lvl <= i.lvl) AS fin, (SELECT min(n.seq) FROM items n WHERE n.fileid = i.fileid AND n.seq > i.seq AND n.lvl IS NULL) AS nxt,
    (SELECT max(p.seq) FROM items p WHERE p.fileid = i.fileid AND p.seq < i.seq AND p.lvl < i.lvl) AS up FROM items i),
  kept AS (SELECT e.* FROM ends e LEFT JOIN ends p ON p.fileid = e.fileid AND p.seq = e.up WHERE e.lvl IS NULL OR (e.nxt IS NOT NULL AND (p.fin IS NULL OR e.nxt < p.fin))),
  events AS (SELECT fileid, seq AS pos, 1 AS o, 0 AS d, CASE WHEN lvl IS NULL THEN {BLOCK} ELSE '<' || {TAG(render.ELEMENT_TAGS, 'type')} || ' class="' || type || '">' || CASE WHEN numero <> '' THEN '<a class="anchor" name="' || type || '/' || numero || '"></a>' ELSE '' END ||
      CASE WHEN titre_nu <> '' THEN '<' || {TAG(render.HEADER_TAGS, 'type')} || ' class="header">' || CASE WHEN numero NOT LIKE '\\_%' ESCAPE '\\' THEN '<span class="level">' || type || '</span><span class="number">' || numero || '</span>' ELSE '' END || '<span class="title">' || titre_nu || '</span></' || {TAG(render.HEADER_TAGS, 'type')} || '>' ELSE '' END END AS html FROM kept
    UNION ALL SELECT fileid, coalesce(fin, 2147483647), 0, -lvl, '</' || {TAG(render.ELEMENT_TAGS, 'type')} || '>' FROM kept WHERE lvl IS NOT NULL)
  SELECT fileid, string_agg(html, '' ORDER BY pos, o, d, html) AS html FROM events GROUP BY fileid"""
)
def element_html(spark, d):
    return render.document_html(numbered_blocks(spark, d))


SPLICED = FOUND.replace("texts", "block_texts") + ", " + r"""laws AS (SELECT *, coalesce(alt, quote) AS x FROM refs),""".rstrip(",") + EXTERNAL[EXTERNAL.index(",\n  read AS"):] + r""",
  hrefs AS (SELECT id, start, stop, quote, CASE WHEN regexp_matches(x, '\barticle [\d\.]+') THEN base || '#se:' || replace(regexp_extract(x, '\barticle ([\d\.]+)', 1), '.', '_') ELSE base END AS href FROM based),
  placed AS (SELECT *, coalesce(lag(stop) OVER (PARTITION BY id ORDER BY start), 0) AS was FROM hrefs),
  joined AS (SELECT p.id, string_agg(substr(b.t, was + 1, start - was) || CASE WHEN href IS NULL THEN quote ELSE '<a target="_blank" href="' || href || '">' || quote || '</a>' END, '' ORDER BY start) AS html, max(stop) AS stop FROM placed p JOIN block_texts b USING (id) GROUP BY p.id),
  linked AS (SELECT b.id, b.fileid, b.first_idx, coalesce(j.html, '') || substr(b.t, coalesce(j.stop, 0) + 1) AS text FROM block_texts b LEFT JOIN joined j USING (id))"""


@query(
    "WITH {words}, " + document.sql_blocks("seg").replace("cut AS", "cut_words AS").replace("FROM cut)", "FROM cut_words)") + ", block_texts AS (SELECT fileid || '#' || first_idx AS id, fileid, first_idx, regexp_replace(text, '[\\s\\p{Z}]', ' ', 'g') AS t, type FROM blocks WHERE type IN (" + ", ".join(f"'{t}'" for t in render.BLOCK_TAGS) + ")), " + SPLICED + f"""
  SELECT l.fileid, l.first_idx, CASE {TAG(render.BLOCK_TAGS, 'b.type')} WHEN '' THEN '' WHEN 'img' THEN '<img alt="' || x.t || '" src="page' || b.page || '-' || concat_ws(',', b.x0, b.top, b.x1, b.bottom) || '.jpg"><br>'
  ELSE '<' || {TAG(render.BLOCK_TAGS, 'b.type')} || '>' || l.text || '</' || {TAG(render.BLOCK_TAGS, 'b.type')} || '>' END AS html FROM linked l JOIN blocks b ON b.fileid = l.fileid AND b.first_idx = l.first_idx JOIN block_texts x ON x.id = l.id"""
)
def linked_html(spark, d):
    """Blocks with the laws they cite as links."""
    blocks = iob.group_blocks(document.tidy(spark, d)).where(F.col("type").isin(*render.BLOCK_TAGS)).withColumn("text", F.regexp_replace("text", SPACES, " "))
    found = F.transform(links.find_references(F.col("text")), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), links.resolve_external(F.coalesce(x["alt"], F.substr(F.col("text"), x["start"] + 1, x["end"] - x["start"]))).alias("href")))
    return blocks.select("fileid", "first_idx", render.block_html(F.col("type"), F.col("text"), found).alias("html"))


def queries() -> dict[str, object]:
    return query.queries


def oracle_sql() -> dict[str, str]:
    return query.sql
