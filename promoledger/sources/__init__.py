"""Tables in and out: registry, literal rows, snapshots, feeds."""
