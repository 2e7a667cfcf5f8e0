"""Prefixes, predicates and datatypes of the output."""

from __future__ import annotations

#: The prefix table of the output format.
PREFIXES = {
    "geo": "http://www.opengis.net/ont/geosparql#",
    "ogc": "http://www.opengis.net/rdf#",
    "ohm": "https://www.openhistoricalmap.org/",
    "ohmchangeset": "https://www.openhistoricalmap.org/changeset/",
    "ohmnode": "https://www.openhistoricalmap.org/node/",
    "ohmnode_tagged": "https://www.openhistoricalmap.org/node/",
    "ohmnode_untagged": "https://www.openhistoricalmap.org/node/",
    "ohmrel": "https://www.openhistoricalmap.org/relation/",
    "ohmway": "https://www.openhistoricalmap.org/way/",
    "osm": "https://www.openstreetmap.org/",
    "osmchangeset": "https://www.openstreetmap.org/changeset/",
    "osmkey": "https://www.openstreetmap.org/wiki/Key:",
    "osmmeta": "https://www.openstreetmap.org/meta/",
    "osmnode": "https://www.openstreetmap.org/node/",
    "osmnode_tagged": "https://www.openstreetmap.org/node/",
    "osmnode_untagged": "https://www.openstreetmap.org/node/",
    "osmrel": "https://www.openstreetmap.org/relation/",
    "osmway": "https://www.openstreetmap.org/way/",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "weave": "https://terraweave.example/rdf#",
    "weavegeom": "https://terraweave.example/rdf/geom#",
    "weavekey": "https://terraweave.example/rdf/key#",
    "weavemeta": "https://terraweave.example/rdf/meta#",
    "wd": "http://www.wikidata.org/entity/",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
}

#: Prefixes of the engine's own terms, by role.
FACT, GEOM, KEYLINK, INFO = "weave", "weavegeom", "weavekey", "weavemeta"
KEY, META, OBJECT = "osmkey", "osmmeta", "osm"

#: Predicates as (prefix, local name).
TYPE = ("rdf", "type")
AS_WKT = ("geo", "asWKT")
HAS_GEOMETRY = ("geo", "hasGeometry")
HAS_CENTROID = ("geo", "hasCentroid")
CONVEX_HULL = (GEOM, "convex_hull")
ENVELOPE = (GEOM, "envelope")
OBB = (GEOM, "obb")
LENGTH = (FACT, "length")
AREA = (FACT, "area")
FACTS = (FACT, "facts")
COMPLETE = (FACT, "hasCompleteGeometry")
REL_MEMBER = ("osmrel", "member")
REL_MEMBER_ID = ("osmrel", "member_id")
REL_MEMBER_ROLE = ("osmrel", "member_role")
REL_MEMBER_POS = ("osmrel", "member_pos")
WAY_MEMBER = ("osmway", "member")
WAY_MEMBER_ID = ("osmway", "member_id")
WAY_MEMBER_POS = ("osmway", "member_pos")
NEXT_NODE = ("osmway", "next_node")
NEXT_NODE_DISTANCE = ("osmway", "next_node_distance")
IS_CLOSED = ("osmway", "is_closed")
NODE_COUNT = ("osmway", "nodeCount")
UNIQUE_NODE_COUNT = ("osmway", "uniqueNodeCount")
TAG = (OBJECT, "tag")
KEY_OF_TAG = (KEY, "key")
VALUE_OF_TAG = (KEY, "value")
SPATIAL = ("Intersects", "Contains", "Covers", "Touches", "Equals", "Overlaps", "Crosses")

#: Subject prefixes by dataset and kind of object.
DATASETS = {
    "osm": {"node": "osmnode", "way": "osmway", "relation": "osmrel", "changeset": "osmchangeset", "id": "osm"},
    "ohm": {"node": "ohmnode", "way": "ohmway", "relation": "ohmrel", "changeset": "ohmchangeset", "id": "ohm"},
}
#: Short names of kinds in geometry ids.
GEOMETRY_KINDS = {"node": "node", "way": "way", "relation": "rel"}

#: Code points that a local name may have as they are (beyond ASCII),
#: and those of them that may not come first.
LOCAL_RANGES = (
    (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x2FF), (0x370, 0x37D), (0x37F, 0x1FFF), (0x200C, 0x200D),
    (0x2070, 0x218F), (0x2C00, 0x2FEF), (0x3001, 0xD7FF), (0xF900, 0xFDCF), (0xFDF0, 0xFFFD), (0x10000, 0xEFFFF),
)
LOCAL_NOT_FIRST = ((0xB7, 0xB7), (0x300, 0x36F), (0x203F, 0x2040))
#: ASCII that a local name escapes with a backslash.
LOCAL_ESCAPED = "!#$%&'()*+,-./;=?@~"
#: ASCII, besides 0x00-0x20, that an IRI reference must not hold.
IRI_RESERVED = '<>{}"|^`\\'

#: Earth radii and the two values of pi in use.
RADIUS_LENGTH = 6378137.0
RADIUS_AREA = 6371008.7714
RADIUS_NEXT = 6371.0 * 1000
PI_NEXT = 3.141592
AREA_DIGITS, LENGTH_DIGITS = 4, 2
