"""What the tables look like: columns, layouts, teams and umpire positions."""
