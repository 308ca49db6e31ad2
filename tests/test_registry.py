"""Registry cases: modules and platforms to jobs."""

from __future__ import annotations

from sheaf import schemas
from sheaf.operators import registry as rg


def modules(spark, items):
    return spark.createDataFrame(
        [("assistant", com, True, {"platforms": [
            {"platform": pid, "name": name, "metadata": meta} for pid, name, meta in plats]})
         for com, plats in items], schemas.MODULES)


def platforms(spark, items):
    return spark.createDataFrame(
        [(pid, name, com, {"baseURL": base, "path": path, "namespaces": ns, "resources": res},
          None, None, None, None) for pid, name, com, base, path, ns, res in items], schemas.PLATFORMS)


def wiki(spark, mods, plats, pid=None):
    return [(r["community_id"], r["platform_id"], r["base_url"], list(r["namespaces"]))
            for r in rg.wiki_jobs(modules(spark, mods), platforms(spark, plats), pid)
            .orderBy("community_id", "position").collect()]


def site(spark, mods, plats, pid=None):
    return [(r["community_id"], r["platform_id"], list(r["urls"]))
            for r in rg.site_jobs(modules(spark, mods), platforms(spark, plats), pid)
            .orderBy("community_id", "position").collect()]


ON = {"activated": True}
OFF = {"activated": False}
P1 = ("mw1", "mediaWiki", "north", "https://alpha.wiki.test", "/w/rest.php", [0, 4, 14], None)
P2 = ("mw2", "mediaWiki", "north", "https://beta.wiki.test", "/w/rest.php", [2, 10, 12], None)


def test_empty(spark):
    assert wiki(spark, [], []) == []
    assert site(spark, [], []) == []


def test_single_wiki(spark):
    got = wiki(spark, [("north", [("mw1", "mediaWiki", ON)])],
               [("mw1", "mediaWiki", "north", "https://gamma.wiki.test", "/w/rest.php", [0, 4, 14], None)])
    assert got == [("north", "mw1", "https://gamma.wiki.test/w/rest.php", [0, 4, 14])]


def test_two_wikis_in_array_order(spark):
    mods = [("north", [("mw1", "mediaWiki", ON), ("mw2", "mediaWiki", ON)])]
    assert wiki(spark, mods, [P1, P2]) == [("north", "mw1", "https://alpha.wiki.test/w/rest.php", [0, 4, 14]),
                                           ("north", "mw2", "https://beta.wiki.test/w/rest.php", [2, 10, 12])]
    assert wiki(spark, mods, [P1, P2], "mw1") == [("north", "mw1", "https://alpha.wiki.test/w/rest.php", [0, 4, 14])]
    assert wiki(spark, mods, [P1, P2], "") == []   # "" is a filter that matches nothing


def test_wiki_not_activated_and_rejects(spark):
    mods = [("north", [("mw1", "mediaWiki", OFF), ("mw2", "mediaWiki", ON), ("mw3", "mediaWiki", {}),
                    ("mw4", "mediaWiki", ON), ("mw5", "mediaWiki", ON), ("mw6", "mediaWiki", ON)])]
    plats = [P1, P2,
             ("mw3", "mediaWiki", "north", "http://x", "/w/rest.php", [0], None),
             ("mw4", "mediaWiki", "north", "http://x", "/w/rest.php", [], None),
             ("mw5", "mediaWiki", "north", None, "/w/rest.php", [0], None)]
    assert [r[1] for r in wiki(spark, mods, plats)] == ["mw2"]
    rej = {(r["kind"], r["reason"]): r["n"] for r in
           rg.job_rejects(modules(spark, mods), platforms(spark, plats)).collect()}
    assert rej == {("mediaWiki", "not_activated"): 1, ("mediaWiki", "missing_activated"): 1,
                   ("mediaWiki", "no_namespaces"): 1, ("mediaWiki", "bad_url_fields"): 1,
                   ("mediaWiki", "platform_not_found"): 1}


def test_single_website_and_other_types(spark):
    mods = [("north", [("w1", "website", ON), ("d1", "discord", {})])]
    plats = [("w1", "website", "north", None, None, None, ["https://one.test/", "https://one.test/docs"])]
    assert site(spark, mods, plats) == [("north", "w1", ["https://one.test/", "https://one.test/docs"])]


def test_website_filter_and_disabled(spark):
    mods = [("north", [("w1", "website", ON), ("w2", "website", ON)])]
    plats = [("w1", "website", "north", None, None, None, ["https://one.test/", "https://one.test/docs"]),
             ("w2", "website", "north", None, None, None, ["https://two.test/", "https://two.test/blog"])]
    assert site(spark, mods, plats, "w1") == [("north", "w1", ["https://one.test/", "https://one.test/docs"])]
    assert len(site(spark, mods, plats, "")) == 2   # "" means no filter for websites
    mods = [("north", [("w1", "website", ON), ("w2", "website", OFF)])]
    assert site(spark, mods, plats) == [("north", "w1", ["https://one.test/", "https://one.test/docs"])]


def test_config_documents_from_json_files(spark, tmp_dir):
    import json
    import os
    from sheaf.sources.config import read_modules, read_platforms
    mod_dir, plat_dir = os.path.join(tmp_dir, "modules"), os.path.join(tmp_dir, "platforms")
    os.makedirs(mod_dir)
    os.makedirs(plat_dir)
    with open(os.path.join(mod_dir, "m.json"), "w") as f:
        f.write(json.dumps({"name": "assistant", "community": "north", "activated": True, "options": {"platforms": [
            {"platform": "mw1", "name": "mediaWiki", "metadata": {"activated": True}},
            {"platform": "d1", "name": "discord", "metadata": {}}]}}) + "\n")
        f.write(json.dumps({"name": "assistant", "community": "south", "options": {"platforms": [
            {"platform": "d2", "name": "discord", "metadata": {"activated": True}}]}}) + "\n")
    with open(os.path.join(plat_dir, "p.json"), "w") as f:
        f.write(json.dumps({"_id": "mw1", "name": "mediaWiki", "community": "north",
                            "metadata": {"baseURL": "https://gamma.wiki.test", "path": "/w/rest.php",
                                         "namespaces": [0, 4, 14]}}) + "\n")
    mods = read_modules(spark, mod_dir, platform_name="mediaWiki")
    assert mods.count() == 1 and "name" not in mods.columns        # S1: filtered, name dropped
    jobs = rg.wiki_jobs(read_modules(spark, mod_dir), read_platforms(spark, plat_dir)).collect()
    assert [(r["community_id"], r["platform_id"], r["base_url"], list(r["namespaces"])) for r in jobs] == [
        ("north", "mw1", "https://gamma.wiki.test/w/rest.php", [0, 4, 14])]
