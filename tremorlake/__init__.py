"""tremorlake: a Spark-native engine for geolocated point events (earthquakes).

Reads GeoJSON feeds (batch or file stream), keeps a raw and a curated table
current through keyed upserts, and answers filtered/paged lists, geodesic
radius searches, zone distance joins, roll-ups and density clusters - all as
DataFrame -> DataFrame operators planned by Catalyst.
"""

__version__ = "0.1.0"
