"""Writers.  Tables are partitioned by scene or split; a re-run replaces its partitions only."""
