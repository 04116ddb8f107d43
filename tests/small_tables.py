"""Where the tests' tables lie: a module whose name no other folder of tests has."""

SF = "/root/testdata/sf0.001"
