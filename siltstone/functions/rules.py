"""Classification of archives: rule tables, as one folded CASE or as a broadcast join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The closed set of categories.
CATEGORIES = ("base", "chemistry", "cybersecurity", "cyberstrategy", "engineering", "history", "math", "medicine", "physics", "programming", "science")
# Sites whose archives all have one category.
SITE_CATEGORY = {
    "wikibooks": "base", "wikiversity": "base", "wiktionary": "base", "wikiquote": "base", "wikisource": "base", "wikivoyage": "base",
    "vikidia": "base", "gutenberg": "base", "mooc": "base", "iFixit": "engineering", "phet": "physics", "psiram": "science",
}
# Substrings of encyclopedia archives and their categories, first match wins.
WIKIPEDIA = (
    ("wikipedia_en_history", "history"),
    ("wikipedia_en_astronomy", "science"),
    ("wikipedia_en_molcell", "science"),
    ("wikipedia_en_climate-change", "science"),
    ("wikipedia_en_medicine", "medicine"),
    ("wikipedia_en_physics", "physics"),
    ("wikipedia_en_chemistry", "chemistry"),
    ("wikipedia_en_mathematics", "math"),
    ("wikipedia_en_computer", "programming"),
    ("wikipedia_en_all", "base"),
    ("wikipedia_en-simple_all", "base"),
    ("wikipedia_en_geography", "base"),
    ("wikipedia_en_sociology", "base"),
    ("wikipedia_en_top1m", "base"),
    ("wikipedia_en_top", "base"),
    ("wikipedia_en_100", "base"),
)
# Encyclopedia archives that are skipped.
WIKIPEDIA_SKIP = (
    "wikipedia_en_football",
    "wikipedia_en_basketball",
    "wikipedia_en_baseball",
    "wikipedia_en_cricket",
    "wikipedia_en_tennis",
    "wikipedia_en_golf",
    "wikipedia_en_ice-hockey",
    "wikipedia_en_movies",
    "wikipedia_en_indian-cinema",
    "wikipedia_en_nollywood",
    "wikipedia_en_ray-charles",
    "wikipedia_en_comics",
    "wikipedia_en_knots",
)
# Question-and-answer hosts and their categories.
HOSTS = (
    ("security.stackexchange.com", "cybersecurity"),
    ("crypto.stackexchange.com", "cybersecurity"),
    ("reverseengineering.stackexchange.com", "cybersecurity"),
    ("tor.stackexchange.com", "cybersecurity"),
    ("physics.stackexchange.com", "physics"),
    ("chemistry.stackexchange.com", "chemistry"),
    ("medicalsciences.stackexchange.com", "medicine"),
    ("history.stackexchange.com", "history"),
    ("genealogy.stackexchange.com", "history"),
    ("hsm.stackexchange.com", "history"),
    ("biology.stackexchange.com", "science"),
    ("astronomy.stackexchange.com", "science"),
    ("earthscience.stackexchange.com", "science"),
    ("space.stackexchange.com", "science"),
    ("scicomp.stackexchange.com", "science"),
    ("mattermodeling.stackexchange.com", "science"),
    ("bioinformatics.stackexchange.com", "science"),
    ("skeptics.stackexchange.com", "science"),
    ("psychology.stackexchange.com", "science"),
    ("math.stackexchange.com", "math"),
    ("mathoverflow.net", "math"),
    ("matheducators.stackexchange.com", "math"),
    ("mathematica.stackexchange.com", "math"),
    ("stats.stackexchange.com", "math"),
    ("or.stackexchange.com", "math"),
    ("proofassistants.stackexchange.com", "math"),
    ("quant.stackexchange.com", "math"),
    ("stackoverflow.com", "programming"),
    ("serverfault.com", "programming"),
    ("superuser.com", "programming"),
    ("askubuntu.com", "programming"),
    ("stackapps.com", "programming"),
    ("unix.stackexchange.com", "programming"),
    ("dba.stackexchange.com", "programming"),
    ("devops.stackexchange.com", "programming"),
    ("softwareengineering.stackexchange.com", "programming"),
    ("cs.stackexchange.com", "programming"),
    ("cstheory.stackexchange.com", "programming"),
    ("codereview.stackexchange.com", "programming"),
    ("codegolf.stackexchange.com", "programming"),
    ("sqa.stackexchange.com", "programming"),
    ("datascience.stackexchange.com", "programming"),
    ("ai.stackexchange.com", "programming"),
    ("genai.stackexchange.com", "programming"),
    ("computergraphics.stackexchange.com", "programming"),
    ("gamedev.stackexchange.com", "programming"),
    ("arduino.stackexchange.com", "programming"),
    ("raspberrypi.stackexchange.com", "programming"),
    ("iot.stackexchange.com", "programming"),
    ("langdev.stackexchange.com", "programming"),
    ("opensource.stackexchange.com", "programming"),
    ("softwarerecs.stackexchange.com", "programming"),
    ("webapps.stackexchange.com", "programming"),
    ("webmasters.stackexchange.com", "programming"),
    ("wordpress.stackexchange.com", "programming"),
    ("drupal.stackexchange.com", "programming"),
    ("joomla.stackexchange.com", "programming"),
    ("magento.stackexchange.com", "programming"),
    ("craftcms.stackexchange.com", "programming"),
    ("expressionengine.stackexchange.com", "programming"),
    ("tridion.stackexchange.com", "programming"),
    ("sitecore.stackexchange.com", "programming"),
    ("salesforce.stackexchange.com", "programming"),
    ("sharepoint.stackexchange.com", "programming"),
    ("tex.stackexchange.com", "programming"),
    ("vi.stackexchange.com", "programming"),
    ("emacs.stackexchange.com", "programming"),
    ("android.stackexchange.com", "programming"),
    ("apple.stackexchange.com", "programming"),
    ("elementaryos.stackexchange.com", "programming"),
    ("blender.stackexchange.com", "programming"),
    ("retrocomputing.stackexchange.com", "programming"),
    ("engineering.stackexchange.com", "engineering"),
    ("electronics.stackexchange.com", "engineering"),
    ("robotics.stackexchange.com", "engineering"),
    ("3dprinting.stackexchange.com", "engineering"),
    ("mechanics.stackexchange.com", "engineering"),
    ("ham.stackexchange.com", "engineering"),
    ("aviation.stackexchange.com", "engineering"),
    ("drones.stackexchange.com", "engineering"),
    ("woodworking.stackexchange.com", "engineering"),
    ("networkengineering.stackexchange.com", "engineering"),
)
# Substrings of other archives and their categories, first match wins.
OTHER = (
    ("armypubs", "cyberstrategy"),
    ("privacydefence.org_en_opsecbible", "cybersecurity"),
    ("anonymousplanet.org", "cybersecurity"),
    ("sh1.org", "cybersecurity"),
    ("thalesdoc", "cybersecurity"),
    ("cloudflare.com_en_learning-center", "cybersecurity"),
    ("medlineplus.gov", "medicine"),
    ("nhs.uk_en_medicines", "medicine"),
    ("wwwnc.cdc.gov", "medicine"),
    ("irp.fas.org_en_military-medicine", "medicine"),
    ("womenshistory.si.edu", "history"),
    ("folgerpedia.folger.edu", "history"),
    ("apod.nasa.gov", "science"),
    ("encyclopedie-environnement.org", "science"),
    ("planetmath", "math"),
    ("stacks.math.columbia.edu", "math"),
    ("mspeekenbrink", "math"),
    ("learningstatisticswithr", "math"),
    ("learningstatistics", "math"),
    ("ethanweed", "math"),
    ("lost-stats.github.io", "math"),
    ("cd3wdproject", "engineering"),
    ("survivorlibrary", "engineering"),
    ("openwrt.org", "engineering"),
    ("php.net", "programming"),
    ("docs.python.org", "programming"),
    ("peps.python", "programming"),
    ("lua.org", "programming"),
    ("dart.dev", "programming"),
    ("getbootstrap", "programming"),
    ("htdp.org", "programming"),
    ("opendatastructures", "programming"),
    ("jeffe.cs.illinois.edu", "programming"),
    ("gobyexample", "programming"),
    ("www.mankier.com", "programming"),
    ("devhints.io", "programming"),
    ("permacomputing.net", "programming"),
    ("khanacademy", "base"),
    ("milneopentextbooks", "base"),
    ("booksdash", "base"),
    ("citizensinformation.ie", "base"),
    ("www.ready.gov_en", "base"),
    ("internet-encyclopedia-philosophy", "base"),
    ("based.cooking", "base"),
    ("foss.cooking", "base"),
    ("publicdomainrecipes", "base"),
    ("grimgrains", "base"),
    ("gotquestions", "base"),
    ("openmusictheory", "base"),
    ("music.dalitio.de", "base"),
    ("mutopiaproject", "base"),
    ("chopin.lib.uchicago.edu", "base"),
    ("solar.lowtechmagazine", "base"),
    ("100r.co", "base"),
)


def substring_rules() -> list[tuple[str, int, str, str]]:
    """(site, ordinal, pattern, category) of all substring rules."""
    return [(site, k, p, c) for site, rules in (("wikipedia", WIKIPEDIA), ("other", OTHER)) for k, (p, c) in enumerate(rules)]


def host_of(name: Column) -> Column:
    return F.substring_index(F.lower(name), "_", 1)


def _first_match(lower: Column, site: str) -> Column:
    """Category of the first rule that the name contains; null if there is none."""
    rules = [(p, c) for s, _, p, c in substring_rules() if s == site]
    return reduce(lambda rest, r: F.when(F.contains(lower, F.lit(r[0])), F.lit(r[1])).otherwise(rest), reversed(rules), F.lit(None).cast("string"))


def classify(site: Column, name: Column) -> Column:
    """The category of an archive, null if it is to be skipped. Narrow: no join, no UDF."""
    lower = F.lower(name)
    skipped = reduce(lambda a, b: a | b, [F.contains(lower, F.lit(s)) for s in WIKIPEDIA_SKIP])
    host = host_of(name)
    by_category: dict[str, list[str]] = {}
    for h, c in HOSTS:
        by_category.setdefault(c, []).append(h)
    exchange = reduce(lambda rest, c: F.when(host.isin(by_category[c]), F.lit(c)).otherwise(rest), by_category, F.lit(None).cast("string"))
    fixed = reduce(lambda rest, s: F.when(site == s, F.lit(SITE_CATEGORY[s])).otherwise(rest), SITE_CATEGORY, F.lit(None).cast("string"))
    return (
        F.when(site == "wikipedia", F.when(~skipped, _first_match(lower, "wikipedia")))
        .when(site == "stack_exchange", exchange)
        .when(site == "other", _first_match(lower, "other"))
        .otherwise(fixed)
    )


def rules_table(spark: SparkSession) -> DataFrame:
    """The substring rules as rows; a fixed 70 of them, so they may be broadcast."""
    return spark.createDataFrame(substring_rules(), "rule_site string, rule_ordinal int, pattern string, category string")


def hosts_table(spark: SparkSession) -> DataFrame:
    """The exact hosts as rows; a fixed 82 of them."""
    return spark.createDataFrame(list(HOSTS), "host string, category string")


def classify_by_join(entries: DataFrame, site: str, name: str, key: str) -> DataFrame:
    """(``key``, category) by a theta join with the broadcast rules; the first rule wins. For rule sets too long for a CASE."""
    rules = F.broadcast(rules_table(entries.sparkSession))
    hit = (F.col(site) == F.col("rule_site")) & F.contains(F.lower(F.col(name)), F.col("pattern"))
    return entries.join(rules, hit).groupBy(key).agg(F.min_by("category", "rule_ordinal").alias("category"))


def classify_hosts(entries: DataFrame, name: str) -> DataFrame:
    """The entries whose host is listed, with its category: an equi-join with the broadcast hosts."""
    return entries.withColumn("host", host_of(F.col(name))).join(F.broadcast(hosts_table(entries.sparkSession)), "host")
