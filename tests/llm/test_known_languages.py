import base64
import random

from pyspark.sql import functions as F

from tessitura.llm.common import read
from tessitura.llm.language_id import keep_known_languages

POLISH = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa."
FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä."


def test_unlearned_languages_and_junk_go(spark, sf_dir):
    rng = random.Random(2)
    letters = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(60))
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    short = [(-10 - i, " ".join(r.text.split()[5:25])) for i, r in enumerate(documents.where(F.size(F.split("text", " ")) > 200).orderBy("doc_id").limit(20).collect())]
    junk = [(-1, POLISH), (-2, FINNISH), (-3, letters), (-4, base64.b64encode(rng.randbytes(600)).decode())]
    added = spark.createDataFrame([(i, t, None) for i, t in junk + short], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in keep_known_languages(documents.unionByName(added)).select("doc_id").collect()}
    assert not kept & {i for i, _ in junk}
    assert {i for i, _ in short} <= kept
    gone = {r.doc_id: r.text for r in documents.collect() if r.doc_id not in kept}
    assert not any(c.isalpha() for t in gone.values() for c in t or "")
