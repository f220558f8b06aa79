"""A small forest for the sample catalogue, to compare results of engines with.

Grown once with the compact pipeline's settings but three trees of depth 4, on the catalogue
of the order tables. Only its splits are kept: class weights of the nodes, and with them
scores, importances and metrics, come from the tables a query reads.
"""

# Tree, node, feature, threshold, node at or below it, node above it.
SPLITS = [
    (0, 0, "genre_idx", 0.5, 1, 12),
    (0, 1, "valence", 0.6045, 2, 7),
    (0, 2, "duration_ms", 124626.0, 3, 6),
    (0, 3, "speechiness", 0.15, 4, 5),
    (0, 7, "year", 2003.5, 8, 9),
    (0, 9, "liveness", 0.385, 10, 11),
    (0, 12, "loudness", -1.45, 13, 20),
    (0, 13, "danceability", 0.5535, 14, 17),
    (0, 14, "tempo", 97.5, 15, 16),
    (0, 17, "energy", 0.665, 18, 19),
    (0, 20, "acousticness", 0.65, 21, 22),
    (0, 22, "liveness", 0.495, 23, 24),
    (1, 0, "duration_ms", 109411.0, 1, 12),
    (1, 1, "acousticness", 0.95, 2, 7),
    (1, 2, "loudness", -30.95, 3, 4),
    (1, 4, "speechiness", 0.05, 5, 6),
    (1, 7, "loudness", -25.25, 8, 11),
    (1, 8, "year", 2008.5, 9, 10),
    (1, 12, "duration_ms", 462098.0, 13, 20),
    (1, 13, "danceability", 0.2425, 14, 17),
    (1, 14, "danceability", 0.1025, 15, 16),
    (1, 17, "energy", 0.5335, 18, 19),
    (1, 20, "loudness", -53.45, 21, 22),
    (1, 22, "energy", 0.034, 23, 24),
    (2, 0, "danceability", 0.2425, 1, 14),
    (2, 1, "loudness", -49.45, 2, 9),
    (2, 2, "instrumentalness", 0.1435, 3, 6),
    (2, 3, "danceability", 0.1575, 4, 5),
    (2, 6, "energy", 0.739, 7, 8),
    (2, 9, "duration_ms", 217427.0, 10, 13),
    (2, 10, "tempo", 55.5, 11, 12),
    (2, 14, "energy", 0.739, 15, 20),
    (2, 15, "tempo", 193.5, 16, 19),
    (2, 16, "duration_ms", 419226.0, 17, 18),
    (2, 20, "loudness", -53.45, 21, 24),
    (2, 21, "instrumentalness", 0.5565, 22, 23),
]
