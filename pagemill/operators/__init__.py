"""DataFrame-to-DataFrame operators over pages, links, snapshots and threads."""
