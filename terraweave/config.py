"""All options of a run, their defaults, how they act on each other, and the CLI."""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, field, fields, replace

from .functions.text import FORMATS

#: Exit codes.
SUCCESS, FAILURE, UNKNOWN_FORMAT = 0, 1, 1
INPUT_MISSING, INPUT_NOT_EXISTS, INPUT_IS_DIRECTORY = 2, 10, 11
OUTPUT_IS_DIRECTORY, CACHE_NOT_EXISTS, CACHE_NOT_DIRECTORY = 12, 21, 22
COMPRESSIONS = ("none", "bz2", "gz")
MERGES = ("none", "concatenate")


@dataclass(frozen=True)
class Config:
    """Defaults are those of the command line."""

    input: str = ""
    output: str = ""
    output_format: str = "qlever"
    output_compression: str = "bz2"
    output_keep_files: bool = False
    #: How parts become the output: "none" leaves them as they are, in an order that a manifest
    #: tells; "concatenate" joins them byte by byte through the driver, for small outputs.
    output_merge: str = "none"
    cache: str = "/tmp"
    store_locations: str = "mem-flex"
    source_dataset: str = "OSM"
    write_ogc_geo_triples: str = "full"
    no_facts: bool = False
    no_area_facts: bool = False
    no_node_facts: bool = False
    no_relation_facts: bool = False
    no_way_facts: bool = False
    no_area_geometric_relations: bool = False
    no_node_geometric_relations: bool = False
    no_relation_geometric_relations: bool = False
    no_way_geometric_relations: bool = False
    no_areas: bool = False
    no_nodes: bool = False
    no_relations: bool = False
    no_ways: bool = False
    add_zero_fact_number: bool = False
    no_untagged_nodes: bool = False
    no_untagged_ways: bool = False
    no_untagged_relations: bool = False
    no_untagged_areas: bool = False
    add_untagged_nodes_geometric_relations: bool = False
    iri_prefix_for_untagged_nodes: str = ""
    add_area_way_linestrings: bool = False
    add_hascentroid: bool = False
    add_hasenvelope: bool = False
    add_hasobb: bool = False
    add_hasconvexhull: bool = False
    add_way_metadata: bool = False
    no_osm_metadata: bool = False
    no_member_triples: bool = False
    add_way_node_spatial_metadata: bool = False
    skip_wiki_links: bool = False
    #: Read and printed, without effect.
    simplify_geometries: float = 0.0
    simplify_wkt: int = 0
    simplify_wkt_deviation: float = 5.0
    wkt_precision: int = 7
    split_tag_key_by_semicolon: tuple[str, ...] = field(default=())
    aux_geo_files: tuple[str, ...] = field(default=())
    num_threads: int = os.cpu_count() or 1
    write_rdf_statistics: bool = False

    def normalised(self) -> Config:
        """The options after their effects on each other."""
        c = self
        if c.write_ogc_geo_triples == "none":
            c = replace(
                c, no_area_geometric_relations=True, no_node_geometric_relations=True,
                no_relation_geometric_relations=True, no_way_geometric_relations=True,
            )
        c = replace(
            c,
            no_area_facts=c.no_area_facts or c.no_facts or c.no_areas,
            no_node_facts=c.no_node_facts or c.no_facts or c.no_nodes,
            no_relation_facts=c.no_relation_facts or c.no_facts or c.no_relations,
            no_way_facts=c.no_way_facts or c.no_facts or c.no_ways,
            no_area_geometric_relations=c.no_area_geometric_relations or c.no_areas,
            no_node_geometric_relations=c.no_node_geometric_relations or c.no_nodes,
            # the switch for ways turns off relations' geometry, that for relations does not
            no_relation_geometric_relations=c.no_relation_geometric_relations or c.no_ways,
            no_way_geometric_relations=c.no_way_geometric_relations or c.no_ways,
        )
        if c.add_way_node_spatial_metadata:
            c = replace(c, no_member_triples=False)
        if not c.iri_prefix_for_untagged_nodes:
            c = replace(c, iri_prefix_for_untagged_nodes=c.tagged_node_iri)
        return c

    @property
    def dataset(self) -> str:
        return self.source_dataset.lower()

    @property
    def tagged_node_iri(self) -> str:
        from .vocabulary import PREFIXES

        return PREFIXES[f"{self.dataset}node"]

    @property
    def separate_untagged(self) -> bool:
        """Whether untagged nodes have a namespace of their own."""
        return self.iri_prefix_for_untagged_nodes not in ("", self.tagged_node_iri)


def option_rows(c: Config) -> list[tuple[str, str, str | None]]:
    """(option, text, datatype) of every option that the output describes, in order.

    The tolerance for geometries is described as a boolean.
    """
    yes = lambda x: ("true" if x else "false", "boolean")
    rows = [
        ("no-area-facts", *yes(c.no_area_facts)),
        ("no-node-facts", *yes(c.no_node_facts)),
        ("no-relation-facts", *yes(c.no_relation_facts)),
        ("no-way-facts", *yes(c.no_way_facts)),
        ("add-zero-fact-number", *yes(c.add_zero_fact_number)),
        ("no-area-geometric-relations", *yes(c.no_area_geometric_relations)),
        ("no-node-geometric-relations", *yes(c.no_node_geometric_relations)),
        ("no-relation-geometric-relations", *yes(c.no_relation_geometric_relations)),
        ("no-way-geometric-relations", *yes(c.no_way_geometric_relations)),
        ("write-ogc-geo-triples", c.write_ogc_geo_triples, None),
        ("source-dataset", c.source_dataset, None),
        ("add-area-way-linestrings", *yes(c.add_area_way_linestrings)),
        ("add-hascentroid", *yes(c.add_hascentroid)),
        ("add-hasenvelope", *yes(c.add_hasenvelope)),
        ("add-hasobb", *yes(c.add_hasobb)),
        ("add-hasconvexhull", *yes(c.add_hasconvexhull)),
        ("add-way-metadata", *yes(c.add_way_metadata)),
        ("no-osm-metadata", *yes(c.no_osm_metadata)),
        ("no-member-triples", *yes(c.no_member_triples)),
        ("add-way-node-spatial-metadata", *yes(c.add_way_node_spatial_metadata)),
        ("skip-wiki-links", *yes(c.skip_wiki_links)),
        ("simplify-geometries", *yes(c.simplify_geometries)),
        ("simplify-wkt", str(c.simplify_wkt), "integer"),
        ("simplify-wkt-deviation", f"{c.simplify_wkt_deviation:.6f}", "double"),
        ("wkt-precision", str(c.wkt_precision), "integer"),
        ("add-untagged-nodes-geometric-relations", *yes(c.add_untagged_nodes_geometric_relations)),
        ("no-untagged-nodes", *yes(c.no_untagged_nodes)),
        ("no-untagged-ways", *yes(c.no_untagged_ways)),
        ("no-untagged-relations", *yes(c.no_untagged_relations)),
        ("no-untagged-areas", *yes(c.no_untagged_areas)),
        ("iri-prefix-for-untagged-nodes", c.iri_prefix_for_untagged_nodes, None),
    ]
    return rows


class ConfigError(SystemExit):
    """A refused command line; its code is the exit code."""


def parse(argv: list[str]) -> Config:
    """The options of a command line, normalised."""
    p = argparse.ArgumentParser(prog="terraweave", allow_abbrev=False)
    short = {"output": "-o", "cache": "-t", "simplify_wkt": "-s"}
    for f in fields(Config):
        if f.name == "input":
            continue
        names = [n for n in (short.get(f.name), "--" + f.name.replace("_", "-")) if n]
        default = f.default
        if isinstance(default, bool):
            p.add_argument(*names, dest=f.name, action="store_true")
        elif isinstance(default, tuple):
            p.add_argument(*names, dest=f.name, action="append", default=[])
        else:
            p.add_argument(*names, dest=f.name, type=type(default), default=default)
    p.add_argument("input", nargs="*")
    try:
        seen = vars(p.parse_args(argv))
    except SystemExit as e:
        raise ConfigError(FAILURE if e.code else SUCCESS) from None
    inputs = seen.pop("input")
    if len(inputs) != 1:
        raise ConfigError(INPUT_MISSING)
    if not os.path.exists(inputs[0]):
        raise ConfigError(INPUT_NOT_EXISTS)
    if os.path.isdir(inputs[0]):
        raise ConfigError(INPUT_IS_DIRECTORY)
    if not os.path.exists(seen["cache"]):
        raise ConfigError(CACHE_NOT_EXISTS)
    if not os.path.isdir(seen["cache"]):
        raise ConfigError(CACHE_NOT_DIRECTORY)
    if seen["output"] and os.path.isdir(seen["output"]):
        raise ConfigError(OUTPUT_IS_DIRECTORY)
    if seen["output_format"] not in FORMATS or seen["output_compression"] not in COMPRESSIONS or seen["output_merge"] not in MERGES:
        raise ConfigError(UNKNOWN_FORMAT)
    if seen["source_dataset"] not in ("OSM", "OHM") or seen["write_ogc_geo_triples"] not in ("full", "none"):
        raise ConfigError(FAILURE)
    if not seen["output"]:
        seen["output_compression"] = "none"
    return Config(input=inputs[0], **{k: tuple(v) if isinstance(v, list) else v for k, v in seen.items()}).normalised()
