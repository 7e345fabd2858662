"""Types of the entities that the readers give."""

from __future__ import annotations

SEQUENCES = "id string, header string, seq string"
HITS = "qseqid string, sseqid string, pident double, length int, evalue double, bitscore double, staxids string"
NODES = "taxid int, parent int, rank string"
PAF = "qname string, qlen long, qstart long, qend long, strand string, tname string, tlen long, tstart long, tend long, nmatch long, alen long, mapq int"
DEPTH = "contig string, pos long, depth long"
